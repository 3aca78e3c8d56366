"""Independent SQL (DuckDB dialect) for each registered query.

Written from the definitions, not from the Spark code: cleaning is the net single
filter (catalogue match, digits-only ISBN, positive rating) rather than the
rule-by-rule tagging; item ids come from ``row_number`` over the whole item table;
the dump is parsed back by comparing with the ratings it was built from.
Doubles are rounded to 6 decimals, as on the Spark side.
"""

from __future__ import annotations


def _isbn(k: str) -> str:
    return (
        f"CASE WHEN {k} % 11 = 10 THEN concat(lpad(CAST({k} AS VARCHAR), 9, '0'), 'X') "
        f"ELSE lpad(CAST({k} AS VARCHAR), 10, '0') END"
    )


BASE = f"""
raw AS (
  SELECT o_custkey AS user_id, {_isbn('l_partkey')} AS isbn, l_partkey AS item_key,
         CASE WHEN o_custkey % 13 = 0 OR l_partkey % 29 = 0 THEN 0
              ELSE CAST(round(l_discount * 100) AS INTEGER) END AS book_rating,
         l_orderkey, l_linenumber, l_extendedprice, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ratings AS (
  SELECT user_id, isbn, item_key, book_rating FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, isbn
        ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_suppkey) AS rn FROM raw) y
  WHERE rn = 1),
books AS (
  SELECT {_isbn('p_partkey')} AS isbn, p_name AS book_title, p_brand AS book_author,
         CAST(1980 + p_size AS INTEGER) AS year_of_publication
  FROM part WHERE p_partkey % 17 <> 0),
full_books AS (
  SELECT b.*, p_type AS publisher, concat('http://images.example.org/P/', b.isbn, '.S.jpg') AS image_url_s,
         concat('http://images.example.org/P/', b.isbn, '.M.jpg') AS image_url_m,
         concat('http://images.example.org/P/', b.isbn, '.L.jpg') AS image_url_l
  FROM books b JOIN part ON b.isbn = {_isbn('p_partkey')}),
users AS (
  SELECT c_custkey AS user_id, CAST(floor(c_acctbal / 100) AS INTEGER) AS age FROM customer),
clean AS (
  SELECT r.* FROM ratings r JOIN books b ON r.isbn = b.isbn
  WHERE NOT regexp_matches(b.isbn, '[^0-9]') AND r.book_rating > 0),
items AS (
  SELECT isbn, CAST(row_number() OVER (ORDER BY count(*) DESC, isbn) - 1 AS INTEGER) AS item_id
  FROM clean GROUP BY isbn),
normed AS (
  SELECT c.user_id, c.isbn, c.item_key, i.item_id, c.book_rating, u.m AS user_mean,
         c.book_rating - u.m AS norm
  FROM clean c JOIN items i ON c.isbn = i.isbn
  JOIN (SELECT user_id, avg(book_rating) AS m FROM clean GROUP BY user_id) u ON c.user_id = u.user_id),
folded AS (
  SELECT *, CASE WHEN left(md5(concat_ws(':', user_id, item_id, 42)), 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split
  FROM normed),
preds AS (
  SELECT t.*, p.pred AS prediction FROM folded t
  JOIN (SELECT item_id, avg(norm) AS pred FROM folded WHERE split = 'train' GROUP BY item_id) p
    ON t.item_id = p.item_id
  WHERE t.split = 'test'),
folds5 AS (
  SELECT n.*, f.fold,
         CASE WHEN left(md5(concat_ws(':', n.user_id, n.item_id, 41 + f.fold)), 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split
  FROM normed n CROSS JOIN (SELECT CAST(range AS INTEGER) AS fold FROM range(1, 6)) f),
cross_preds AS (
  SELECT t.*, m.model, m.prediction FROM folds5 t
  JOIN (SELECT fold AS model, item_id, avg(norm) AS prediction FROM folds5 WHERE split = 'train'
        GROUP BY fold, item_id) m ON t.item_id = m.item_id
  WHERE t.split = 'test'),
cross_pairs AS (
  SELECT ub.model, ub.fold, ub.r AS ub_rmse, ib.r AS ib_rmse FROM
    (SELECT model, fold, avg(r) AS r FROM (
       SELECT model, fold, user_id, sqrt(avg((norm - prediction) * (norm - prediction))) AS r
       FROM cross_preds GROUP BY model, fold, user_id) GROUP BY model, fold) ub
  JOIN (SELECT model, fold, avg(r) AS r FROM (
       SELECT model, fold, item_id, sqrt(avg((norm - prediction) * (norm - prediction))) AS r
       FROM cross_preds GROUP BY model, fold, item_id) GROUP BY model, fold) ib
  ON ub.model = ib.model AND ub.fold = ib.fold),
cross_eval AS (
  SELECT model, avg(ub_rmse) AS ub_rmse_avg, avg(ib_rmse) AS ib_rmse_avg FROM cross_pairs GROUP BY model),
best AS (
  SELECT * FROM (SELECT 'UBCF' AS method, model, ub_rmse_avg AS rmse FROM cross_eval ORDER BY ub_rmse_avg, model LIMIT 1)
  UNION ALL
  SELECT * FROM (SELECT 'IBCF' AS method, model, ib_rmse_avg AS rmse FROM cross_eval ORDER BY ib_rmse_avg, model LIMIT 1)),
lookup AS (
  SELECT x.isbn, x.item_id, coalesce(t.book_title, 'Unknown') AS book_title
  FROM (SELECT DISTINCT isbn, item_id FROM normed) x
  LEFT JOIN (SELECT isbn, min(book_title) AS book_title FROM books GROUP BY isbn) t ON x.isbn = t.isbn),
scores AS (
  SELECT user_id, item_id, round(prediction, 9) AS score FROM preds),
ranked AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM scores)
  WHERE rank <= 10),
rec_lines AS (
  SELECT user_id, CAST(count(*) AS INTEGER) AS n_items,
         string_agg(label, '  ' ORDER BY rank) || repeat('  ', CAST(greatest(10 - count(*), 0) AS INTEGER)) AS line
  FROM (SELECT r.user_id, r.rank,
               CASE WHEN coalesce(substring(l.book_title, 1, 12), '') <> '' THEN substring(l.book_title, 1, 12)
                    ELSE 'Item' || CAST(r.item_id AS VARCHAR) END AS label
        FROM ranked r LEFT JOIN lookup l ON r.item_id = l.item_id)
  GROUP BY user_id),
dump AS (
  SELECT 'BX-Book-Ratings.sql' AS source,
         printf('INSERT IGNORE INTO `BX-Book-Ratings` VALUES (%d,''%s'',%d);', user_id, isbn, book_rating) AS value
  FROM raw
  UNION ALL
  SELECT 'BX-Books.sql',
         printf('INSERT IGNORE INTO `BX-Books` VALUES (''%s'',''%s'',''%s'',%d,''%s'',''%s'',''%s'',''%s'');', isbn,
                replace(replace(book_title, '\\', '\\\\'), '''', '\\'''),
                replace(replace(book_author, '\\', '\\\\'), '''', '\\'''), year_of_publication,
                replace(replace(publisher, '\\', '\\\\'), '''', '\\'''), image_url_s, image_url_m, image_url_l)
  FROM full_books
  UNION ALL
  SELECT 'BX-Users.sql', printf('INSERT IGNORE INTO `BX-Users` VALUES (%d,%s);', user_id,
         coalesce(CAST(age AS VARCHAR), 'NULL'))
  FROM users
  UNION ALL
  SELECT * FROM (VALUES
    ('BX-Book-Ratings.sql', 'CREATE TABLE `BX-Book-Ratings` (`User-ID` int(11) NOT NULL default ''0'', `ISBN` varchar(13) NOT NULL default '''', `Book-Rating` int(11) NOT NULL default ''0'', PRIMARY KEY (`User-ID`,`ISBN`)) ENGINE=MyISAM DEFAULT CHARSET=latin1;'),
    ('BX-Books.sql', 'CREATE TABLE `BX-Books` (`ISBN` varchar(13) NOT NULL default '''', `Book-Title` varchar(255) default NULL, `Book-Author` varchar(255) default NULL, `Year-Of-Publication` int(10) unsigned default NULL, `Publisher` varchar(255) default NULL, `Image-URL-S` varchar(255) default NULL, `Image-URL-M` varchar(255) default NULL, `Image-URL-L` varchar(255) default NULL, PRIMARY KEY (`ISBN`)) ENGINE=MyISAM DEFAULT CHARSET=latin1;'),
    ('BX-Users.sql', 'CREATE TABLE `BX-Users` (`User-ID` int(11) NOT NULL default ''0'', `Age` int(11) default NULL, PRIMARY KEY (`User-ID`)) ENGINE=MyISAM DEFAULT CHARSET=latin1;')
  ) h(source, value)),
dump_norm AS (
  SELECT source,
    replace(regexp_replace(
    replace(replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(regexp_replace(value, 'ENGINE=\\w+\\s*', '', 'gi'), 'DEFAULT CHARSET=\\w+\\s*', '', 'gi'),
      '`BX-Users`', 'BX_Users', 'g'), '`BX-Books`', 'BX_Books', 'g'), '`BX-Book-Ratings`', 'BX_Book_Ratings', 'g'),
      'User-ID', 'User_ID'), 'Book-Rating', 'Book_Rating'), 'Year-Of-Publication', 'Year_Of_Publication'),
      'Book-Title', 'Book_Title'), 'Book-Author', 'Book_Author'), 'Image-URL-S', 'Image_URL_S'),
      'Image-URL-M', 'Image_URL_M'), 'Image-URL-L', 'Image_URL_L'),
      'INSERT IGNORE INTO', 'INSERT OR IGNORE INTO', 'gi'), '\\''', '''''') AS value
  FROM dump)
"""


def _q(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body.strip()


def _basics(users: str, books: str, ratings: str) -> str:
    """Profile report lines (section, part, key, line) over three named relations."""
    return f"""
  SELECT '3.a' AS section, 1 AS part, CAST(0 AS BIGINT) AS key, printf('3.a) how many users?       %d', (SELECT count(*) FROM {users})) AS line
  UNION ALL SELECT '3.b', 1, 0, printf('3.b) how many books?       %d', (SELECT count(*) FROM {books}))
  UNION ALL SELECT '3.c', 1, 0, printf('3.c) how many ratings?     %d', (SELECT count(*) FROM {ratings}))
  UNION ALL SELECT '3.d', 1, bin, printf('| %3d | %5d  |', bin, n) FROM (
    SELECT n_r AS bin, count(*) AS n FROM (SELECT user_id, count(*) AS n_r FROM {ratings} WHERE book_rating > 0 GROUP BY user_id) GROUP BY n_r)
  UNION ALL SELECT '3.e', 1, bin, printf('| %3d | %5d  |', bin, n) FROM (
    SELECT n_r AS bin, count(*) AS n FROM (SELECT isbn, count(*) AS n_r FROM {ratings} WHERE book_rating > 0 GROUP BY isbn) GROUP BY n_r)
  UNION ALL SELECT '3.f', 1, rank, printf('| %-18s | %5d  |', book_title, n) FROM (
    SELECT book_title, n, row_number() OVER (ORDER BY n DESC, isbn) AS rank FROM (
      SELECT r.isbn, min(b.book_title) AS book_title, count(*) AS n FROM {ratings} r JOIN {books} b ON r.isbn = b.isbn
      WHERE r.book_rating > 0 GROUP BY r.isbn) ORDER BY n DESC, isbn LIMIT 10)
  UNION ALL SELECT '3.g', 1, rank, printf('| %-6s | %5d  |', CAST(user_id AS VARCHAR), n) FROM (
    SELECT user_id, n, row_number() OVER (ORDER BY n DESC, user_id) AS rank FROM (
      SELECT user_id, count(*) AS n FROM {ratings} WHERE book_rating > 0 GROUP BY user_id) ORDER BY n DESC, user_id LIMIT 10)
  UNION ALL SELECT * FROM (VALUES
    ('3.d', 0, 0, '3.d) histogram of user-ratings <table(num ratings, num users)>'),
    ('3.d', 0, 1, '(how many users have rated N times?)'),
    ('3.d', 0, 2, '+-----+-------+'), ('3.d', 0, 3, '| bin | N     |'), ('3.d', 0, 4, '+-----+-------+'),
    ('3.d', 2, 0, '+-----+-------+'),
    ('3.e', 0, 0, '3.e) histogram of book-ratings <table(num ratings, num books)>'),
    ('3.e', 0, 1, '(how many books have been rated N times?)'),
    ('3.e', 0, 2, '+-----+-------+'), ('3.e', 0, 3, '| bin | N     |'), ('3.e', 0, 4, '+-----+-------+'),
    ('3.e', 2, 0, '+-----+-------+'),
    ('3.f', 0, 0, '3.f) top-10 rated books?'), ('3.f', 0, 1, '+--------------------+-------+'),
    ('3.f', 0, 2, '| name               | N     |'), ('3.f', 0, 3, '+--------------------+-------+'),
    ('3.f', 2, 0, '+--------------------+-------+'),
    ('3.g', 0, 0, '3.g) top-10 active users?'), ('3.g', 0, 1, '+--------+-------+'),
    ('3.g', 0, 2, '| user id   | N     |'), ('3.g', 0, 3, '+--------+-------+'),
    ('3.g', 2, 0, '+--------+-------+')) v(section, part, key, line)
"""


CLEAN_BOOKS = """(SELECT isbn, book_title, book_author,
   CASE WHEN year_of_publication > 2025 THEN NULL ELSE year_of_publication END AS year_of_publication
   FROM books WHERE NOT (isbn = '' OR regexp_matches(isbn, '[^0-9]')))"""
CLEAN_USERS = """(SELECT user_id, CASE WHEN age < 6 OR age > 80 THEN NULL ELSE age END AS age FROM users)"""

SEQUENTIAL = """
t1 AS (
  SELECT r.*, CASE WHEN b.isbn IS NULL THEN 'orphan'
                   WHEN r.isbn = '' OR regexp_matches(r.isbn, '[^0-9]') THEN 'invalid_isbn' END AS d
  FROM ratings r LEFT JOIN (SELECT DISTINCT isbn FROM books) b ON r.isbn = b.isbn),
zu AS (SELECT user_id FROM t1 WHERE d IS NULL GROUP BY user_id HAVING sum(book_rating) = 0),
t2 AS (SELECT t1.user_id, t1.isbn, t1.book_rating,
              CASE WHEN t1.d IS NULL AND zu.user_id IS NOT NULL THEN 'zero_user' ELSE t1.d END AS d
       FROM t1 LEFT JOIN zu ON t1.user_id = zu.user_id),
zi AS (SELECT isbn FROM t2 WHERE d IS NULL GROUP BY isbn HAVING sum(book_rating) = 0),
t3 AS (SELECT t2.user_id, t2.isbn, t2.book_rating,
              CASE WHEN t2.d IS NULL AND zi.isbn IS NOT NULL THEN 'zero_item' ELSE t2.d END AS d
       FROM t2 LEFT JOIN zi ON t2.isbn = zi.isbn),
t4 AS (SELECT user_id, isbn, book_rating,
              CASE WHEN d IS NULL AND book_rating = 0 THEN 'zero_rating' ELSE d END AS d FROM t3)
"""

ORACLE: dict[str, str] = {
    "top_books": _q("""
SELECT CAST(row_number() OVER (ORDER BY n_ratings DESC, isbn) AS INTEGER) AS rank, isbn, book_title, book_author, n_ratings
FROM (SELECT r.isbn, first(b.book_title ORDER BY b.book_title NULLS LAST, b.book_author NULLS LAST) AS book_title,
        first(b.book_author ORDER BY b.book_title NULLS LAST, b.book_author NULLS LAST) AS book_author, count(r.book_rating) AS n_ratings
      FROM ratings r JOIN books b ON r.isbn = b.isbn WHERE r.book_rating > 0 GROUP BY r.isbn
      ORDER BY n_ratings DESC, isbn LIMIT 10)"""),
    "top_users": _q("""
SELECT CAST(row_number() OVER (ORDER BY n_ratings DESC, user_id) AS INTEGER) AS rank, user_id, n_ratings
FROM (SELECT user_id, count(*) AS n_ratings FROM ratings WHERE book_rating > 0 GROUP BY user_id
      ORDER BY n_ratings DESC, user_id LIMIT 10)"""),
    "hist_users": _q("""
SELECT n_r AS bin, count(*) AS n FROM (SELECT user_id, count(*) AS n_r FROM ratings WHERE book_rating > 0 GROUP BY user_id) GROUP BY n_r"""),
    "hist_books": _q("""
SELECT n_r AS bin, count(*) AS n FROM (SELECT isbn, count(*) AS n_r FROM ratings WHERE book_rating > 0 GROUP BY isbn) GROUP BY n_r"""),
    "table_counts": _q("""
SELECT 'users' AS metric, count(*) AS n FROM users
UNION ALL SELECT 'books', count(*) FROM books
UNION ALL SELECT 'ratings', count(*) FROM ratings"""),
    "sparsity": _q("""
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, count(*) AS n_ratings,
       round(1 - count(*) / (CAST(count(DISTINCT user_id) AS DOUBLE) * count(DISTINCT item_id)), 6) AS sparsity
FROM normed"""),
    "ratings_per_user": _q("""
SELECT user_id, count(*) AS n_ratings FROM ratings WHERE book_rating > 0 GROUP BY user_id"""),
    "invalid_isbn": _q("""
SELECT count(*) AS n_invalid_books FROM books WHERE isbn = '' OR regexp_matches(isbn, '[^0-9]')"""),
    "invalid_book_ratings": _q("""
SELECT count(*) AS n_ratings FROM ratings
WHERE isbn IN (SELECT isbn FROM books WHERE isbn = '' OR regexp_matches(isbn, '[^0-9]'))"""),
    "orphan_ratings": _q("""
SELECT user_id, isbn, book_rating FROM ratings WHERE isbn NOT IN (SELECT isbn FROM books)"""),
    "drop_orphans": _q("""
SELECT user_id, isbn, book_rating FROM ratings WHERE NOT (isbn NOT IN (SELECT isbn FROM books)) OR isbn IS NULL"""),
    "clean_counts": "WITH " + BASE.strip() + "," + SEQUENTIAL + """
SELECT coalesce(d, 'kept') AS rule, count(*) AS n_rows FROM t4 GROUP BY 1""",
    "clean_ratings": _q("SELECT user_id, isbn, item_key, book_rating FROM clean"),
    "clean_ratings_fused": _q("SELECT user_id, isbn, item_key, book_rating FROM clean"),
    "clean_books": _q("SELECT * FROM " + CLEAN_BOOKS),
    "clean_users": _q("SELECT * FROM " + CLEAN_USERS),
    "clean_age": _q("SELECT user_id, CASE WHEN age < 6 OR age > 80 THEN NULL ELSE age END AS age FROM users"),
    "clean_year": _q("""
SELECT isbn, CASE WHEN year_of_publication > 2025 THEN NULL ELSE year_of_publication END AS year_of_publication
FROM books"""),
    "zero_users": _q("SELECT user_id FROM ratings GROUP BY user_id HAVING sum(book_rating) = 0"),
    "zero_items": _q("SELECT isbn FROM ratings GROUP BY isbn HAVING sum(book_rating) = 0"),
    "drop_zero_users": _q("""
SELECT user_id, isbn, book_rating FROM ratings
WHERE user_id NOT IN (SELECT user_id FROM ratings GROUP BY user_id HAVING sum(book_rating) = 0)"""),
    "drop_zero": _q("SELECT user_id, isbn, book_rating FROM ratings WHERE NOT (book_rating = 0) OR book_rating IS NULL"),
    "dedup_ratings": _q("SELECT user_id, isbn, item_key, book_rating FROM ratings"),
    "index_items": _q("SELECT isbn, item_id FROM items"),
    "center_ratings": _q("""
SELECT user_id, isbn, item_id, book_rating, round(user_mean, 6) AS user_mean, round(norm, 6) AS norm FROM normed"""),
    "ui_matrix": _q("SELECT user_id, isbn, book_rating FROM clean"),
    "split_sizes": _q("SELECT fold, split, count(*) AS n_rows FROM folds5 GROUP BY fold, split"),
    "rmse_by_user": _q("""
SELECT user_id, round(sqrt(avg((norm - prediction) * (norm - prediction))), 6) AS rmse FROM preds GROUP BY user_id"""),
    "rmse_by_item": _q("""
SELECT item_id, round(sqrt(avg((norm - prediction) * (norm - prediction))), 6) AS rmse FROM preds GROUP BY item_id"""),
    "rmse_by_user_raw": _q("""
SELECT user_id, round(sqrt(avg((book_rating - prediction) * (book_rating - prediction))), 6) AS rmse
FROM preds GROUP BY user_id"""),
    "macro_rmse": _q("""
SELECT round((SELECT avg(r) FROM (SELECT sqrt(avg((norm - prediction) * (norm - prediction))) AS r FROM preds GROUP BY user_id)), 6) AS ub_rmse,
       round((SELECT avg(r) FROM (SELECT sqrt(avg((norm - prediction) * (norm - prediction))) AS r FROM preds GROUP BY item_id)), 6) AS ib_rmse,
       round((SELECT sqrt(avg((norm - prediction) * (norm - prediction))) FROM preds), 6) AS rmse,
       (SELECT count(*) FROM preds) AS n_pred"""),
    "global_rmse": _q("SELECT round(sqrt(avg((norm - prediction) * (norm - prediction))), 6) AS rmse FROM preds"),
    "rmse_hist": _q("""
SELECT bin, CAST(sum(u) AS BIGINT) AS n_ubcf, CAST(sum(i) AS BIGINT) AS n_ibcf FROM (
  SELECT floor(r / 0.25) * 0.25 AS bin, 1 AS u, 0 AS i FROM (
    SELECT sqrt(avg((norm - prediction) * (norm - prediction))) AS r FROM preds GROUP BY user_id)
  UNION ALL
  SELECT floor(r / 0.25) * 0.25, 0, 1 FROM (
    SELECT sqrt(avg((norm - prediction) * (norm - prediction))) AS r FROM preds GROUP BY item_id))
GROUP BY bin"""),
    "cross_eval": _q("SELECT model, round(ub_rmse_avg, 6) AS ub_rmse_avg, round(ib_rmse_avg, 6) AS ib_rmse_avg FROM cross_eval"),
    "best_model": _q("SELECT method, model, round(rmse, 6) AS rmse FROM best"),
    "sample_users": _q("""
SELECT user_id FROM (SELECT DISTINCT user_id FROM clean)
ORDER BY md5(CAST(user_id AS VARCHAR) || ':42'), user_id LIMIT 250"""),
    "items_lookup": _q("SELECT isbn, item_id, book_title FROM lookup"),
    "items_lookup_nobooks": _q("SELECT DISTINCT isbn, item_id, CAST(isbn AS VARCHAR) AS book_title FROM normed"),
    "rec_topk": _q("SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM ranked"),
    "rec_lines": _q("SELECT user_id, n_items, line FROM rec_lines"),
    "factor_topk": _q("""
SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, score FROM (
  SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
    SELECT user_id, item_id, CAST(u.n * i.top + u.total * i.n AS DOUBLE) AS score
    FROM (SELECT user_id, count(*) AS n, sum(book_rating) AS total FROM normed GROUP BY user_id) u
    CROSS JOIN (SELECT item_id, max(book_rating) AS top, count(*) AS n FROM normed GROUP BY item_id) i))
WHERE rank <= 10"""),
    "dump_statements": _q("SELECT * REPLACE (replace(book_title, ' ', ';' || chr(10)) AS book_title) FROM full_books"),
    "dump_normalize": _q("SELECT source, value FROM dump_norm"),
    "dump_insert_count": _q("""
SELECT source, CAST(sum(CASE WHEN upper(value) LIKE '%INSERT%' THEN 1 ELSE 0 END) AS BIGINT) AS n_insert_lines
FROM dump_norm GROUP BY source"""),
    "dump_parse": _q("SELECT user_id, isbn, book_rating FROM ratings"),
    "dump_parse_books": _q("SELECT * FROM full_books"),
    "basics_report": _q(
        "SELECT * FROM (" + _basics(CLEAN_USERS, CLEAN_BOOKS, "clean") + ")"
    ),
    "basics_delta": _q(
        "SELECT 'before' AS stage, * FROM (" + _basics("users", "books", "ratings") + ")\n"
        "UNION ALL SELECT 'after', * FROM (" + _basics(CLEAN_USERS, CLEAN_BOOKS, "clean") + ")"
    ),
    "model_report": _q("""
SELECT '6.a' AS section, 1 AS part, CAST(0 AS BIGINT) AS key,
       printf('6.a) RMSE of the full model UB %.6f, IB %.6f',
              (SELECT rmse FROM best WHERE method = 'UBCF'), (SELECT rmse FROM best WHERE method = 'IBCF')) AS line
UNION ALL
SELECT '6.b', 1, CAST(round(bin / 0.25) AS BIGINT), printf('%.2f  %-8d %-8d', bin, n_ubcf, n_ibcf) FROM (
  SELECT bin, sum(u) AS n_ubcf, sum(i) AS n_ibcf FROM (
    SELECT floor(r / 0.25) * 0.25 AS bin, 1 AS u, 0 AS i FROM (
      SELECT sqrt(avg((norm - prediction) * (norm - prediction))) AS r FROM preds GROUP BY user_id)
    UNION ALL
    SELECT floor(r / 0.25) * 0.25, 0, 1 FROM (
      SELECT sqrt(avg((norm - prediction) * (norm - prediction))) AS r FROM preds GROUP BY item_id))
  GROUP BY bin)
UNION ALL
SELECT '6.c UBCF', 1, user_id, printf('%s  %s', CAST(user_id AS VARCHAR), line) FROM rec_lines
UNION ALL SELECT * FROM (VALUES
  ('6.b', 0, 0, '6.b) histogram of RMSE <table(bin, num occurrences UBCF, num occurrences IBCF)>'),
  ('6.b', 0, 1, 'RMSE'),
  ('6.b', 0, 2, '      N.UBCF   N.IBCF'),
  ('6.c', 0, 0, '6.c) Top-10 recommendations   <table(user,book1,book2,book3, ..., book10)>')) v(section, part, key, line)"""),
}
