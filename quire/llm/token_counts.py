"""Token counts of a sentencepiece BPE model without making the tokens.

The symbols of a word lie in a linked list and its mergeable neighbours in a heap. The
pair of the best score (the leftmost of equals) is popped and merged until no pair is
left. Each merge takes one symbol away, so the count is the number of initial symbols
minus the number of merges; no identifiers are looked up. A character that is no piece
is as many symbols as it has UTF-8 bytes (byte fallback); it merges with nothing.

The model file is read on the driver; what is broadcast has the size of its vocabulary.
"""

from __future__ import annotations

import heapq
import re
from functools import cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField

from .common import append_columns

#: The character that stands for a blank inside pieces.
BLANK = "▁"
#: Words that a worker remembers with their counts; it starts anew when full.
CACHE_WORDS = 400_000
#: Longer words are counted but not remembered.
CACHED_CHARS = 64
#: Texts of more characters are cut into words one by one, not at once.
AT_ONCE = 1 << 20


class Pieces:
    """The model's merges as ranks: ``ranks[piece]`` is the place of its score, 0 the best;
    pieces of equal score share a place. Refuses models whose counts the rule in the
    module's docstring would not give."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        normal = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in normal}
        probe = " aﬁ\t ① b "
        self.prefix = BLANK if model.normalize("a").startswith(BLANK) else ""
        if model.normalize(probe) != (self.prefix + probe).replace(" ", BLANK):
            raise ValueError(f"{path} normalizes texts")
        if sum(map(model.is_byte, ids)) != 256 or any(map(model.is_unused, ids)):
            raise ValueError(f"{path} has no byte pieces, or pieces that are not used")
        self.chars = {p for p in pieces if len(p) == 1}
        longer = [p for p in pieces if len(p) > 1]
        inner = set("".join(longer))
        if not inner <= self.chars:
            raise ValueError(f"{path} has pieces of characters that are no pieces")
        self.pairs = {p[i : i + 2] for p in longer for i in range(len(p) - 1)}
        places = {score: i for i, score in enumerate(sorted({pieces[p] for p in longer}, reverse=True))}
        self.ranks = {p: places[pieces[p]] for p in longer}
        # No merge crosses from another character to a blank, or from a letter to a mark, or
        # meets what stands alone.
        self.cut_at_blanks = not any(BLANK in p.lstrip(BLANK) for p in longer)
        after = {p[1] for p in self.pairs if p[0].isalpha()}
        self.marks = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in after)
        self.alone = "".join(c for c in map(chr, range(128)) if c not in inner)

    def pattern(self) -> str:
        """Matches the stretches of a text that no merge leaves."""
        alone = re.escape(self.alone)
        if not self.cut_at_blanks:
            return f"[{alone}]|[^{alone}]+" if alone else r"(?s:.+)"
        one = f"[{alone}]|" if alone else ""
        letters = rf"{BLANK}*+[^\W\d_]++(?=[{re.escape(self.marks)}])|" if self.marks else ""
        return f"{one}{letters}{BLANK}+[^{alone}{BLANK}]*|[^{alone}{BLANK}]+"

    def state(self) -> tuple:
        return self.ranks, self.chars, self.pairs, self.prefix, self.pattern()


def merge_free_parts(word: str, pairs: set[str]) -> list[str]:
    """``word`` cut between neighbours that stand beside each other in no piece: no merge
    crosses there, so the parts' counts add up."""
    cuts = [i + 1 for i in range(len(word) - 1) if word[i : i + 2] not in pairs]
    return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]


def count_merges(word: str, ranks: dict[str, int]) -> int:
    """Merges that happen in ``word``: least rank first, the leftmost among equals.

    A heap entry packs rank, first symbol and end of the pair into one integer, so that
    entries compare as (rank, place)."""
    n = len(word)
    bits = (n + 1).bit_length()
    ones = (1 << bits) - 1
    rank_of = ranks.get
    heap = [
        ((r << bits | i) << bits) | (i + 2)
        for i in range(n - 1)
        if (r := rank_of(word[i : i + 2])) is not None
    ]
    if not heap:
        return 0
    heapq.heapify(heap)
    end = list(range(1, n + 2))  # symbol i is word[i:end[i]], the next one starts at end[i]
    before = list(range(-1, n))
    merges = 0
    while heap:
        entry = heapq.heappop(heap)
        stop, i = entry & ones, entry >> bits & ones
        j = end[i]
        if not i < j < stop or end[j] != stop:  # a symbol of this pair has changed or gone
            continue
        merges += 1
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            last = end[stop]
            if (r := rank_of(word[i:last])) is not None:
                heapq.heappush(heap, ((r << bits | i) << bits) | last)
        h = before[i]
        if h >= 0 and (r := rank_of(word[h:stop])) is not None:
            heapq.heappush(heap, ((r << bits | h) << bits) | stop)
    return merges


class Counter(dict):
    """word -> tokens, filled as words are met."""

    def __init__(self, state: tuple):
        super().__init__()
        self.ranks, self.chars, self.pairs, self.prefix, pattern = state
        self.words = re.compile(pattern)

    def __missing__(self, word: str) -> int:
        parts = [word] if word.isalpha() else merge_free_parts(word, self.pairs)
        if len(parts) > 1:
            return sum(map(self.__getitem__, parts))
        if self.chars.issuperset(word):
            symbols = len(word)
        else:
            symbols = sum(1 if c in self.chars else len(c.encode("utf-8")) for c in word)
        n = symbols - count_merges(word, self.ranks)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n

    def tokens(self, text: str) -> int:
        if not text:
            return 0
        text = (self.prefix + text).replace(" ", BLANK)
        if len(text) <= AT_ONCE:
            return sum(map(self.__getitem__, self.words.findall(text)))
        return sum(self[m.group()] for m in self.words.finditer(text))


@cache
def _state(path: str) -> tuple:
    return Pieces(path).state()


_COUNTERS: dict[tuple[str, str], Counter] = {}


def token_counts(docs: DataFrame, model: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` with n_bytes (of the text in UTF-8), n_tokens (as the model gives them,
    without begin and end; control pieces' strings in a text are ordinary text) and
    over_limit (n_tokens > ``limit``).

    A null text is an empty one: no bytes, no tokens. Texts are counted whole; a long word
    costs n log n. Repeated rows stay, an empty table gives an empty one. Input columns
    named like an output one, in any case, are replaced by it; all others are kept. Runs
    where the rows are: no shuffle, no ties to break. A worker keeps the counts of at most
    CACHE_WORDS words from one task to the next."""
    sc = docs.sparkSession.sparkContext
    key, shared = (sc.applicationId, model), sc.broadcast(_state(model))

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(shared.value)
        count = _COUNTERS[key].tokens
        size, n = [], []
        for t in batch.column(batch.schema.get_field_index(text)):
            t = t.as_py() or ""
            size.append(len(t.encode("utf-8")))
            n.append(count(t))
        return [pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]

    fields = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    return append_columns(docs, fields, make)
