"""Token counts, ranked search and conversation repair against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from conftest import SF0001, SF001
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import ranked_search as rs
from quire.llm.conversation_repair import cheapest_edits, damage, repair_conversations
from quire.llm.queries import op13_conversation_repair
from quire.llm.ranked_search import ranked_search
from quire.llm.token_counts import Counter as TokenCounter
from quire.llm.token_counts import Pieces, count_merges, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n\n", "a", "é  \x1c x", "x" * 5000, "word " * 3000, "\x00 nul", "▁ ▁a <s> </s><unk><0x41>", "乎규 𐍈😀 1234567890"]


# --- token counts


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_equal_the_library_on_documents(spark, library):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    for r in token_counts(docs, MODEL, limit=300).collect():
        assert r["n_tokens"] == len(library.encode(r["text"] or ""))
        assert r["n_bytes"] == len((r["text"] or "").encode()) and r["over_limit"] == (r["n_tokens"] > 300)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abehint  ▁\n\t.,'<s>/0é한"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_counts_equal_the_library_on_any_text(text):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert TokenCounter(Pieces(MODEL).state()).tokens(text) == len(library.encode(text))


def test_odd_texts_clashes_and_empty_table(spark, library):
    rows = [(i, t, "x", "y") for i, t in enumerate(ODD + ODD[-1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS string, word string")
    out = token_counts(docs, MODEL)
    assert out.columns == ["doc_id", "text", "word", "n_bytes", "n_tokens", "over_limit"]
    got = {r["doc_id"]: r["n_tokens"] for r in out.collect()}
    assert got == {i: len(library.encode(t or "")) for i, t, *_ in rows}
    assert token_counts(docs.limit(0), MODEL).collect() == []


def test_long_word_and_long_text(library):
    counter = TokenCounter(Pieces(MODEL).state())
    for text in ("the" * 40_000, "ab " * 500_000):
        assert counter.tokens(text) == len(library.encode(text))


def test_merges_of_equal_rank_go_left_to_right():
    assert count_merges("aaa", {"aa": 0}) == 1 and count_merges("aaaa", {"aa": 0, "aaaa": 0}) == 3
    assert count_merges("abc", {"bc": 0, "ab": 1}) == 1 and count_merges("", {}) == 0


# --- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_search(docs, items, k):
    bags = [(i, Counter(words(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc, bag in bags:
            n = sum(bag.values())
            score = 0
            for t in terms & bag.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * n * n_docs) // total
                score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is not None, doc or 0))
        out += [(item, r + 1, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scored)[:k])]
    return out


def searched(spark, docs, items, k, extra="n string, item string"):
    d = spark.createDataFrame([(*r, "x", "y") for r in docs], f"doc_id long, text string, {extra}")
    i = spark.createDataFrame([(*r, "x", "y") for r in items], "item_id long, text string, doc string, score string")
    return sorted((tuple(r) for r in ranked_search(d, i, k).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("leaf,block", [(1, 40), (8, 200), (1024, 400_000)])
def test_search_equals_brute_force(spark, monkeypatch, leaf, block):
    """Small leaves and blocks make the best-first search split down to single documents."""
    r = random.Random(leaf)
    vocabulary = [f"w{int(r.paretovariate(0.7))}" for _ in range(300)] + ["É", "Ab-c"]
    docs = [(i, " ".join(r.choices(vocabulary, k=r.randrange(30)))) for i in range(150)]
    docs += [(None, docs[3][1]), (7, docs[7][1]), (900, docs[7][1]), (901, None), (902, ""), (903, "w1 " * 50_000)]
    items = [(i, " ".join(r.choices(vocabulary, k=12))) for i in range(8)] + [(3, "w1 w2"), (None, "W1 ab"), (90, None), (91, "--")]
    monkeypatch.setattr(rs, "LEAF_POSTINGS", leaf)
    monkeypatch.setattr(rs, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(rs, "QUERY_TERMS", 25)
    assert searched(spark, docs, items, 5) == in_order(brute_search(docs, items, 5))


def test_search_of_empty_tables(spark):
    assert searched(spark, [], [(1, "a")], 5) == []
    assert searched(spark, [(1, "a b")], [], 5) == []
    assert searched(spark, [(1, None), (2, "..")], [(1, "a")], 5) == []


@pytest.mark.parametrize("seed", range(3))
def test_block_search_splits_down_to_documents(monkeypatch, seed):
    """The search itself, without Spark: every interval is split, none is scored whole."""
    import numpy as np

    monkeypatch.setattr(rs, "LEAF_POSTINGS", 0)
    r = np.random.default_rng(seed)
    held = sorted({(int(d), int(t)) for d, t in zip(r.integers(0, 200, 1500), r.zipf(1.5, 1500) % 40)})
    docs, terms = (np.array(x) for x in zip(*held))
    impacts = r.integers(1, 50, len(held))
    block = rs.Block(terms, docs, impacts, 40, 200)
    for size in (1, 3, 12):
        query = r.choice(40, size, replace=False)
        best = rs.Best(10)
        block.search(query, best, range(200))
        sums = np.bincount(docs[np.isin(terms, query)], weights=impacts[np.isin(terms, query)], minlength=200)
        want = sorted(((-int(s), d) for d, s in enumerate(sums) if s > 0))[:10]
        assert sorted((-s, last.doc) for s, last in best.rows) == want


# --- conversation repair


def brute_repair(initials, unfit, late):
    """Cheapest (cost, audit) by uniform-cost search over the grammar's states."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    best, heap, done = None, [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if i == len(initials) and state in (0, 3):
            best = min(best or (cost, audit), (cost, audit))
        if (audit, i, state) in done:
            continue
        done.add((audit, i, state))
        for letter in "ua":
            if (to := after.get((state, letter))) and audit.count("I") < 4:
                heapq.heappush(heap, (cost + 5, audit + "I", i, to))
        if i < len(initials):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state))
            if not unfit[i]:
                if to := after.get((state, initials[i])):
                    heapq.heappush(heap, (cost + 5 * late[i], audit + "K", i + 1, to))
                for letter in "ua":
                    if to := after.get((state, letter)):
                        heapq.heappush(heap, (cost + 1 + 5 * late[i], audit + "R", i + 1, to))
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "u", "a", "x", ""]), st.sampled_from(["", "", "", "unfit", "late"])), max_size=7))
def test_edits_equal_brute_force(turns):
    initials, unfit, late = [t[0] for t in turns], [t[1] == "unfit" for t in turns], [t[1] == "late" for t in turns]
    assert cheapest_edits(initials, unfit, late) == brute_repair(initials, unfit, late)


def rows_of(turns):
    """Damage as the contract words it, on plain rows: (conv, turn, role, text)."""
    out = {}
    for conv, turn, role, text in turns:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        rows = out.setdefault(conv, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:])) for c, rows in out.items()}


def brute_conversation(rows):
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    numbers = {r[0] for r in rows} - {None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = brute_repair(initials, [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
    kept, i = [], 0
    for edit in audit:
        if edit != "D":
            kept.append((edit, *rows[i][1:]) if edit != "I" else (edit, "", ""))
        i += edit != "I"
    start = len(kept) % 2
    lines = [f"{role if edit == 'K' else ('user', 'assistant')[(j - start) % 2]}:{text}" for j, (edit, role, text) in enumerate(kept)]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest


def test_query_equals_brute_force(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: brute_conversation(rows) for c, rows in rows_of(turns).items()}
    got = {r["conv_id"]: tuple(r)[1:] for r in op13_conversation_repair(spark, SF001).collect()}
    assert got == want and len(got) == 100


def test_nulls_ties_repeats_and_clashing_names(spark, tmp_dir):
    r = random.Random(5)
    texts = [None, "", " \x0b", "Yes.", "No", "é!", "long " * 50_000 + "?"]
    roles = [None, "user", "assistant", "system", "", "tool"]
    turns = [(c, r.choice([None, 0, 1, 2, 3, 3]), r.choice(roles), r.choice(texts)) for c in [None, *range(60)] for _ in range(r.randrange(1, 7))]
    frame = spark.createDataFrame([(*t, "x", "y", "z") for t in turns], "conv_id long, turn long, role string, text string, key string, cost string, fault string")
    frame.coalesce(1).write.parquet(f"{tmp_dir}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in op13_conversation_repair(spark, tmp_dir).collect()}
    assert got == {c: brute_conversation(rows) for c, rows in rows_of(turns).items()}
    assert repair_conversations(frame.limit(0)).collect() == [] and damage(frame.limit(0)).collect() == []


def test_conversation_without_turns_is_returned(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a.", True), (2, 0, "user", "a.", False)], "conv_id long, turn long, role string, text string, absent boolean")
    got = {r["conv_id"]: (r["cost"], r["audit"], r["turns"]) for r in repair_conversations(frame, absent="absent").collect()}
    assert got == {1: (0, "", []), 2: (2, "D", [])}


def test_long_conversation():
    r = random.Random(2)
    initials = ["ua"[i % 2] for i in range(3000) if r.random() > 0.05]
    cost, audit = cheapest_edits(initials, [False] * len(initials), [False] * len(initials))
    assert len(audit.replace("I", "")) == len(initials)
    assert cost == 2 * audit.count("D") + 5 * audit.count("I") + audit.count("R")


# --- characters outside an alphabet


def test_characters_outside_the_alphabet_have_their_own_figures():
    import numpy as np

    from quire.llm import char_lm

    common = [chr(0x4E00 + i) for i in range(200)]
    draw = random.Random(3)
    texts = ["".join(draw.choice(common) for _ in range(400)).encode() for _ in range(40)]
    count = Counter("".join(t.decode() for t in texts))
    alphabet = [ord(c) for c, _ in count.most_common(char_lm.SYMBOLS - char_lm.FIRST)]
    table = char_lm.alphabet_table(alphabet)
    codes, sizes, points = char_lm.gram_codes(texts, table)
    assert list(points) == [ord(c) for t in texts for c in t.decode()] and sizes.sum() == len(points)
    grams, n = np.unique(codes, return_counts=True)
    rest = {ord(c): k for c, k in count.items() if ord(c) not in alphabet}
    model = char_lm.estimate(grams, n, np.array(list(rest)), np.array(list(rest.values())))
    seen = np.array(sorted(rest))
    p = np.exp(model.logp_of_other(seen))
    assert abs(p.sum() + (char_lm.CODE_POINTS - len(seen)) * np.exp(model.other_floor) - 1) < 1e-9
    total = sum(rest.values())
    for c, x in zip(seen, p):
        assert abs(x - rest[c] / total) < 0.5 / total

    def loss(text):
        codes, sizes, points = char_lm.gram_codes([text.encode()], table)
        return -model.logp_of_characters(codes, points).sum() / sizes[0]

    # Both texts are all outside the alphabet: the one of signs never seen is far less likely.
    known = "".join(chr(c) for c in list(rest)[:50])
    assert loss("".join(chr(0x9000 + i) for i in range(50))) > loss(known) + 5
    empty = char_lm.estimate(grams, n, np.zeros(0, dtype=np.int64), np.zeros(0))
    assert empty.logp_of_other(np.array([65])) == [-np.log(char_lm.CODE_POINTS)]


def test_a_script_of_many_signs_is_judged_by_its_signs(spark):
    from quire.llm.quality_rules import quality_rules

    draw = random.Random(5)
    signs = [chr(0x4E00 + i) for i in range(600)]
    weights = [1 / (i + 5) for i in range(600)]
    text = lambda some, w: " ".join("".join(draw.choices(some, w, k=2)) + str(draw.randrange(9)) for _ in range(120))
    rare = [chr(0xAC00 + 7 * i) for i in range(600)]
    for others in (0, 700):  # the language's model broadcast, or met in groups
        rows = [(i, text(signs, weights), "zh") for i in range(60)] + [(100, text(rare, [1] * 600), "zh")]
        rows += [(1000 + i, "some plain words of another language " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(150)), f"l{i % 2}") for i in range(others)]
        out = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
        assert sum(out[i]["kept"] for i in range(60)) >= 55
        assert not out[100]["kept"] and out[100]["log_perplexity"] > max(out[i]["log_perplexity"] for i in range(60))


def test_ngrams_outside_the_alphabet_have_their_own_figures():
    """Over every character, the probabilities after a context sum to one; texts whose signs follow one another as
    they do in the others are likelier than the same signs shuffled, and a text is judged by the others alone."""
    import numpy as np

    from quire.llm import char_lm

    signs = [chr(0x4E00 + i) for i in range(200)]
    after = {c: random.Random(i).sample(signs, 3) for i, c in enumerate(signs)}
    draw = random.Random(4)

    def chain(n):
        out = [draw.choice(signs)]
        while len(out) < n:
            out.append(draw.choice(after[out[-1]]))
        return "".join(out)

    texts = [chain(300).encode() for _ in range(60)]
    count = Counter("".join(t.decode() for t in texts))
    alphabet = [ord(c) for c, _ in count.most_common(char_lm.SYMBOLS - char_lm.FIRST)]
    table = char_lm.alphabet_table(alphabet)
    codes, sizes, points, at, rare = char_lm.grams_of(texts, table)
    grams, n = np.unique(codes, return_counts=True)
    rest = {ord(c): k for c, k in count.items() if ord(c) not in alphabet}
    model = char_lm.estimate(grams, n, np.array(list(rest)), np.array(list(rest.values())))
    model.rare = char_lm.Rare.of(rare, np.ones(len(rare)), table)

    def logps(some, owned):
        codes, sizes, points, at, rare = char_lm.grams_of([t.encode() for t in some], table)
        owner = np.searchsorted(np.cumsum(sizes), at, side="right") if owned else None
        return model.logp_of_grams(codes, points, at, rare, table, owner), sizes

    inside = "".join(map(chr, alphabet[:3]))
    for context in (texts[0].decode()[:3], texts[1].decode()[50:53], inside, "xyz"):
        found, sizes = logps([context + c for c in map(chr, [*alphabet, *rest])], False)
        ends = found[np.cumsum(sizes) - 1]
        unseen = logps([context + chr(0x9000)], False)[0][-1]
        left = char_lm.CODE_POINTS - len(rest)
        symbols = np.exp(ends).sum() + left * np.exp(unseen)
        # Symbols that no character has (padding, part of an alphabet that is not full) keep their share.
        assert 0.9 < symbols < 1 + 1e-6
    held, shuffled = chain(200), list(chain(200))
    draw.shuffle(shuffled)
    (a, _), (b, _) = logps([held], False), logps(["".join(shuffled)], False)
    assert -a.mean() + 1.5 < -b.mean()
    # Of a text that is counted itself, its own n-grams say nothing: those signs occur nowhere else.
    odd = "".join(chr(0xAC00 + i) for i in range(200))
    codes, sizes, points, at, rare = char_lm.grams_of([*texts, odd.encode()], table)
    model.rare = char_lm.Rare.of(rare, np.ones(len(rare)), table)
    assert -logps([odd], True)[0].mean() > -logps([odd], False)[0].mean() + 2
