"""Personal data: keyed surrogates, in DataFrame operations only.

1. One pattern finds the entities; a text is its entities and the gaps between them.
   A name is a title and any number of parts, each an entity of its own: "Mr John Smith" and
   "Mr Smith" share a part. Parts that return without a title in the text are replaced too.
2. The distinct entities (type and canonical value: so mentions of one in other formats or
   cases are one) get a surrogate from a keyed hash, of the same type, gender and script.
   Surrogates that two entities share, or that are themselves an entity of the texts, are
   drawn again for all but one, until there are none: distinct entities stay distinct.
3. Each mention is its entity's surrogate in the mention's own format.

Texts without entities pass through where they are. The others meet their surrogates by
the list of their mentions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.skew import join_small

from .common import materialize

#: Titles by gender, and the patterns of the types, in the order of their test.
FEMALE = r"Mrs|Ms|Miss|Mme|Mlle|Frau|Señora|Sra|г-жа"
MALE = r"Mr|Herr|Monsieur|Señor|Sr|г-н"
TITLE = r"(?:%s)\.?\s+"
#: A part of a name: an initial, or a word that may hold hyphens and apostrophes; scripts
#: without capitals begin with any letter. Repeated groups are possessive here and below:
#: Java repeats other groups by recursion, and a long text would overflow its stack.
PART = r"[\p{Lu}\p{Lo}](?:\.|(?:[\p{L}\p{M}]|['’-](?!s(?!\p{L}))\p{L})++|(?<=\p{Lo}))"
NAMES = rf"{PART}(?:(?:\s++|(?<=\.)){PART})*+"
KEYWORD = r"(?:password|passwd|secret|token|api_key)\s?[=:]\s?[\"']?"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "key": r"(?<![\p{L}\p{N}])AKIA[0-9A-Z]{16}(?![\p{L}\p{N}])",
    "secret": rf"(?<![\p{{L}}\p{{N}}]){KEYWORD}[^\s\"']{{6,}}",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![0-9])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "female": rf"(?<!\p{{L}}){TITLE % FEMALE}{NAMES}",
    "male": rf"(?<!\p{{L}}){TITLE % MALE}{NAMES}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Syllables of invented names, by script.
LATIN = "ba be bi bo da de di do fa fe ga ge ka ke la le li lo ma me mi mo na ne ni no ra re ro sa".split()
CYRILLIC = "ба бе би бо да де ди до фа фе га ге ка ке ла ле ли ло ма ме ми мо на не ни но ра ре ро са".split()
#: First of 24 letters that follow each other in other scripts' Unicode blocks.
OTHER_SCRIPTS = {
    "Greek": "α",
    "Armenian": "ա",
    "Georgian": "ა",
    "Hebrew": "א",
    "Arabic": "ا",
    "Devanagari": "क",
    "Thai": "ก",
    "Hiragana": "さ",
    "Katakana": "サ",
    "Hangul": "가",
    "Han": "一",
}
SYLLABLES, MOST_SYLLABLES = 4, 10
MAX_DRAWS = 40


def entity_table(mentions: DataFrame) -> DataFrame:
    """mentions (mention) with lead (what stays before it: title, keyword, space), type and
    canon; a name is one row (k) for each of its parts."""
    m = F.col("mention")
    kind = F.lit("card")
    for name in reversed([k for k in PATTERNS if k != "card"]):
        kind = F.when(m.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(kind)
    lead = F.when(kind == "secret", F.regexp_extract(m, f"^{KEYWORD}", 0)).when(
        kind.isin("female", "male"), F.regexp_extract(m, "^" + TITLE % f"{FEMALE}|{MALE}", 0)
    )
    lead = F.coalesce(lead, F.lit(""))
    own = mentions.withColumns({"type": kind, "lead": lead})
    own = own.withColumn("mention", F.substring("mention", F.length("lead") + 1, F.length("mention")))
    name = F.col("type").isin("female", "male")
    # A part travels with the gap before it, not with all gaps of its name.
    gaps = F.when(name, F.split("mention", PART)).otherwise(F.array(F.lit("")))
    parts = F.when(name, F.regexp_extract_all("mention", F.lit(PART), F.lit(0))).otherwise(F.array("mention"))
    pairs = F.zip_with(gaps, parts, lambda g, p: F.struct(g.alias("gap"), p.alias("part")))
    own = own.select(*[c for c in own.columns if c != "mention"], F.posexplode(F.filter(pairs, lambda x: x["part"].isNotNull())).alias("k", "_pair"))
    own = own.withColumn("lead", F.when(F.col("k") == 0, F.col("lead")).otherwise(F.col("_pair.gap")))
    own = own.withColumn("mention", F.col("_pair.part")).drop("_pair")
    digits = F.regexp_replace("mention", "[^0-9]", "")
    t = F.col("type")
    canon = F.when(t.isin("phone", "card"), digits).when(t.isin("key", "secret", "ip"), F.col("mention")).otherwise(F.lower("mention"))
    return own.withColumn("canon", canon)


def _hex(part: str) -> Column:
    return F.sha2(F.concat_ws("\u0001", "seed", F.lit(part), F.col("draw").cast("string")), 256)


def _digits(h: Column, n: Column) -> Column:
    """n decimal digits of a hash: each hexadecimal digit as one, a to f as 0 to 5."""
    return F.substring(F.repeat(F.translate(h, "abcdef", "012345"), 8), F.lit(1), n)


def _name(h: Column, syllables: list[str], end: str) -> Column:
    """SYLLABLES syllables, one more for each draw: the names do not run out."""
    of = F.array(*map(F.lit, syllables))

    def syllable(i: int) -> Column:
        one = F.get(of, F.pmod(F.conv(F.substring(h, 1 + 6 * i, 6), 16, 10).cast("int"), F.lit(len(syllables))))
        return one if i < SYLLABLES else F.when(F.col("draw") > i - SYLLABLES, one).otherwise("")

    return F.initcap(F.concat(*[syllable(i) for i in range(MOST_SYLLABLES)], F.lit(end)))


def _alike(value: Column, h: Column) -> Column:
    """``value`` with letters for its letters, by case, and digits for its digits."""

    def other(c: Column, i: Column) -> Column:
        drawn = F.conv(F.substring(h, 1 + F.pmod(i * 2, F.lit(62)), F.lit(2)), 16, 10).cast("int")
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), 1 + F.pmod(drawn, F.lit(26)), F.lit(1))
        return (
            F.when(c.rlike("^[0-9]$"), F.pmod(drawn, F.lit(10)).cast("string"))
            .when(c.rlike(r"^\p{Lu}$"), F.upper(letter))
            .when(c.rlike(r"^\p{L}$"), letter)
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), other), "")


def surrogate_of() -> Column:
    """The surrogate of (type, canon, draw), in canonical form. ``seed``, the keyed hash of
    type and canon, stands for them: the hash of a long value is not made for each of its
    characters."""
    h, h2 = _hex("a"), _hex("b")
    n = F.length("canon")
    octet = [F.conv(F.substring(h, 1 + 4 * i, 4), 16, 10).cast("int") for i in range(4)]
    ip = F.concat_ws(".", (1 + F.pmod(octet[0], F.lit(222))).cast("string"), *[F.pmod(o, F.lit(255)).cast("string") for o in octet[1:]])
    body = F.concat(F.substring("canon", 1, 1), _digits(h, n - 2))
    # Luhn: from the right of the body, every other digit is doubled.
    at = F.transform(F.split(F.reverse(body), ""), lambda c, i: F.when(i % 2 == 0, F.pmod(c.cast("int") * 2, F.lit(10)) + F.floor(c.cast("int") / 5)).otherwise(c.cast("int")).cast("int"))
    luhn = F.pmod(-F.aggregate(at, F.lit(0), lambda s, x: s + x), F.lit(10)).cast("string")

    def name(latin: str, cyrillic: str) -> Column:
        found = F.when(F.col("canon").rlike(r"\p{IsCyrillic}"), _name(h, CYRILLIC, cyrillic))
        for script, first in OTHER_SCRIPTS.items():
            letters = [chr(ord(first) + i) for i in range(24)]
            found = found.when(F.col("canon").rlike(rf"\p{{Is{script}}}"), _name(h, letters, ""))
        return found.otherwise(_name(h, LATIN, latin))

    t = F.col("type")
    # Drawn again, a surrogate leaves the entity's length, so that short ones do not run out.
    local = F.concat(_alike(F.substring_index("canon", "@", 1), h), F.when(F.col("draw") > 0, _digits(h2, F.col("draw") + 3)).otherwise(""))
    return (
        F.when(t == "email", F.concat(local, F.lit("@mail.example.net")))
        .when(t == "key", F.concat(F.lit("AKIA"), F.upper(F.substring(h, 1, 16))))
        .when(t == "secret", F.when(F.col("draw") < 4, _alike(F.col("canon"), h)).otherwise(F.substring(F.repeat(h, 64), F.lit(1), F.greatest(n, F.lit(12)))))
        .when(t == "ip", ip)
        .when(t == "phone", F.concat(F.substring("canon", 1, 1), _digits(h, n - 1)))
        .when(t == "card", F.concat(body, luhn))
        .when(t == "female", name("na", "на"))
        .otherwise(name("n", "н"))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(type, canon, surrogate) of distinct (type, canon): no two of a type share one, and
    none is an entity of its type."""
    seed = F.sha2(F.concat_ws("\u0001", F.lit(key), "type", "canon"), 256)
    entities = materialize(entities.withColumn("seed", seed), "entities")
    own = entities.select("type", F.col("canon").alias("taken"))
    pending, done = entities.withColumn("draw", F.lit(0)), None
    for _ in range(MAX_DRAWS):
        drawn = pending.withColumn("surrogate", surrogate_of()).withColumn("taken", F.lower("surrogate"))
        drawn = drawn.withColumn("taken", F.when(F.col("type").isin("key", "ip", "secret"), F.col("surrogate")).otherwise(F.col("taken")))
        used = own.withColumn("_used", F.lit(True))
        if done is not None:
            used = used.unionByName(done.select("type", "taken").withColumn("_used", F.lit(True)))
        first = drawn.groupBy("type", "taken").agg(F.min("canon").alias("_first"))
        drawn = drawn.join(first, ["type", "taken"]).join(used.distinct(), ["type", "taken"], "left")
        drawn = drawn.withColumn("_ok", F.col("_used").isNull() & (F.col("canon") == F.col("_first")))
        drawn = materialize(drawn, "drawn")
        good = drawn.filter("_ok").select("type", "canon", "surrogate", "taken")
        done = good if done is None else done.unionByName(good)
        pending = drawn.filter("NOT _ok").select("type", "canon", "seed", (F.col("draw") + 1).alias("draw"))
        if pending.isEmpty():
            return done.drop("taken")
    raise ValueError(f"entities without a surrogate of their own after {MAX_DRAWS} draws")


def formatted(mention: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's format: digits in the places of digits, capitals kept."""
    def digit(c: Column, i: Column) -> Column:
        at = F.length(F.regexp_replace(F.substring(mention, F.lit(1), i + 1), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substring(surrogate, at, F.lit(1))).otherwise(c)

    in_place = F.array_join(F.transform(F.split(mention, ""), digit), "")
    shouted = (F.upper(mention) == mention) & (F.lower(mention) != mention) & (F.length(mention) > 2) & kind.isin("email", "female", "male")
    return F.when(kind.isin("phone", "card"), in_place).when(shouted, F.upper(surrogate)).otherwise(surrogate)


def replace_personal_data(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced by surrogates, and n_entities.

    The same key gives the same surrogates for the same set of entities. Null stays null, with
    0 entities; untitled repeats of names are replaced and not counted; a text without
    entities stays as it is. Repeated rows get equal results, and an empty table an empty
    one. Whole texts are searched, whatever their length. A column n_entities (in any case)
    is replaced; all others are kept, whatever their names.
    """
    kept = [c for c in docs.columns if c.lower() not in (text.lower(), "n_entities")]
    order = [c for c in docs.columns if c.lower() != "n_entities"]
    # The caller's columns travel as one, so that no name of theirs meets one used here.
    row = F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(0)]).alias("_row")
    found = docs.select(
        row, F.col(f"`{text}`").alias("_text"), F.coalesce(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(ENTITY), F.lit(0)), F.array().cast("array<string>")).alias("_found")
    )
    clean = found.filter(F.size("_found") == 0).select("_row", F.col("_text").alias("_new_text"), F.lit(0).cast("long").alias("_n_found"))
    # Written, so that the patterns run over all texts no more often than need be.
    marked = materialize(found.filter(F.size("_found") > 0), "marked")
    marked = marked.withColumn("_gaps", F.split("_text", ENTITY)).drop("_text")
    marked = marked.withColumnRenamed("_found", "_mentions").withColumn("_list", F.sha2(F.to_json("_mentions"), 256))
    lists = marked.groupBy("_list").agg(F.any_value("_mentions").alias("_mentions"), F.count("*").alias("_n"))
    lists = materialize(lists, "mention-lists")
    mentions = entity_table(lists.select("_list", F.posexplode("_mentions").alias("at", "mention")))
    mentions = materialize(mentions, "mentions")
    entities = mentions.groupBy("type", "canon").agg(F.count("*").alias("_n"))
    new = surrogates(entities.select("type", "canon"), key)
    named = join_small(mentions, new, ["type", "canon"], "inner", counts=lambda: entities)
    # A mark, which no surrogate holds, begins each mention but the first.
    begin = F.when((F.col("k") == 0) & (F.col("at") > 0), "\u0001").otherwise("")
    said = F.concat(begin, "lead", formatted(F.col("mention"), F.col("type"), F.col("surrogate")))
    part = F.col("type").isin("female", "male") & ~F.col("mention").endswith(".")
    named = named.select("_list", F.struct("at", "k", said.alias("s")).alias("s"), F.when(part, F.struct("canon", "surrogate")).alias("p"))
    replies = named.groupBy("_list").agg(
        F.split(F.array_join(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["s"]), ""), "\u0001").alias("_new"),
        F.sort_array(F.collect_set("p")).alias("_parts"),
    )
    joined = join_small(marked, replies, "_list", "inner", counts=lambda: lists.select("_list", "_n"))

    def untitled(gap: Column) -> Column:
        """The gap with the parts of the text's names replaced."""
        word = rf"(?<!\p{{L}}){PART}"

        def reply(w: Column) -> Column:
            hit = F.get(F.filter("_parts", lambda p: p["canon"] == F.lower(w)), F.lit(0))["surrogate"]
            return F.coalesce(F.when((F.upper(w) == w) & (F.length(w) > 2), F.upper(hit)).otherwise(hit), w)

        words = F.transform(F.regexp_extract_all(gap, F.lit(word), F.lit(0)), reply)
        return F.array_join(F.zip_with(F.split(gap, word), words, lambda g, w: F.concat(g, F.coalesce(w, F.lit("")))), "")

    gaps = F.when(F.size("_parts") > 0, F.transform("_gaps", untitled)).otherwise(F.col("_gaps"))
    whole = F.array_join(F.zip_with(gaps, "_new", lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")
    done = joined.select("_row", whole.alias("_new_text"), F.size("_new").cast("long").alias("_n_found"))
    out = [F.col("_new_text").alias(c) if c.lower() == text.lower() else F.col("_row").getField(c).alias(c) for c in order]
    return clean.unionByName(done).select(*out, F.col("_n_found").alias("n_entities"))
