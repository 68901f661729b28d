"""Personal data: exact base spans, and more by bootstrapped contexts.

Base spans (email, ip, card, phone) and long mixed runs of letters and digits
(secret) are the seeds.  The one and two words before a mention, on its line,
are its lexical patterns.  Rounds over the corpus, scored in Spark:

1. A pattern with ``support`` distinct known instances of a kind is a
   candidate, unless plain words are more than 1 - ``confidence`` of its
   mentions; all mentions behind candidates make up the pattern-instance graph.
2. A candidate's confidence in a kind is the share of its distinct instances
   that are known for that kind, by their scores; what is trusted already gave
   them, so none is known by the candidate's own help.  Instances of another
   kind and plain words count against it, other unknown ones half.
   Confident candidates are trusted.
3. An unknown instance scores 1 - prod(1 - confidence) over its trusted
   patterns.  Those that score enough are known from now on: the words before
   them elsewhere in the corpus are the candidates of the next round.

Without newly known instances the rounds end.  Every mention behind a trusted
pattern that is no plain word is then marked as of its kind.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .state import bounded_batches, in_turn, release, written
from .textcore import SPACED_LOWER, U64, Slice, mix, slices

KINDS = ("email", "ip", "card", "phone")
#: Kinds of which only the method marks spans: secrets (keys, tokens) beside the base kinds.
LEARNT = (*KINDS, "secret")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its first digit fails from each: none is tried inside a run.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SECRET = re.compile(r"[0-9A-Za-z]{32,}")
_GROUP = re.compile(r"[\s]+([0-9+().,/-]*[0-9][0-9+().,/-]*)(?=\s|$)")
_TRIM = ".,;:!?\"'`()[]{}<>|*#$%&="
#: Patterns that each task may hold as a broadcast table; more are joined instead, with equal results.
BLOCK = 200_000
#: Least and most bits (8 MiB) of the filter that stands for any number of
#: patterns or instances; what passes is joined exactly.
LEAST_BITS, MOST_BITS = 16, 26
_SPAN = "array<struct<kind:string,start:int,end:int,base:boolean>>"
Span = tuple[str, int, int]


def _emails(t: str) -> Iterator[Span]:
    upto, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > upto and t[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield "email", start, m.end()
            upto = m.end()
        at = t.find("@", max(at + 1, upto))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(t: str) -> list[Span]:
    """All base spans, by kind as in KINDS and then by start."""
    out = list(_emails(t))
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(t) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(t):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(t):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def _secrets(t: str) -> Iterator[Span]:
    for m in _SECRET.finditer(t):
        digits = sum(c in "0123456789" for c in m[0])
        if 0 < digits < len(m[0]):
            yield "secret", m.start(), m.end()


def seed_spans(t: str) -> list[Span]:
    """Base spans, and secrets clear of them."""
    base = base_spans(t)
    return base + [s for s in _secrets(t) if not any(a < s[2] and s[1] < b for _, a, b in base)]


def _id(t: str) -> int:
    """Of a whole mention, whatever its length."""
    return int.from_bytes(hashlib.blake2b(t.lower().encode(), digest_size=8).digest(), "little", signed=True)


def _plain(t: str) -> bool:
    """Letters, and characters beyond ASCII, alone."""
    return all(c > "\x7f" or c.isalpha() for c in t)


class _Lines:
    """Words of texts for the search of contexts: runs without white space, cut
    behind ``:`` and ``=``; with the hashes of the patterns before each word."""

    def __init__(self, s: Slice):
        data, offsets = s.data, s.offsets
        n = len(data)
        solid = s.table[0][data]
        mark = (data == 0x3A) | (data == 0x3D)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.append(False, solid[:-1] & ~mark[:-1]) & ~edge[:n] if n else solid
        s.start = np.flatnonzero(solid & ~before)
        behind = np.append(solid[1:], False) & ~edge[1:] & ~mark if n else solid
        s.end = np.flatnonzero(solid & ~behind) + 1
        s.first = np.searchsorted(s.start, offsets)
        self.s, self.h = s, s.hashes
        upto = np.concatenate([[0], np.cumsum(data == 0x0A)])
        line = upto[s.start]
        name = np.zeros(256, bool)
        name[0x30:0x3A] = name[0x41:0x5B] = name[0x61:0x7B] = name[0x80:] = True
        said = np.concatenate([[0], np.cumsum(name[data])])
        said = said[s.end] > said[s.start]
        m = len(s.start)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(s.first))
        one, two = np.zeros(m, bool), np.zeros(m, bool)
        one[1:] = (line[1:] == line[:-1]) & (doc[1:] == doc[:-1])
        two[2:] = one[2:] & one[1:-1] & (said[1:-1] | said[:-2])
        one[1:] &= said[:-1]
        with np.errstate(over="ignore"):
            h1 = np.append(U64(0), self.h[:-1])[:m]
            h2 = np.append(np.zeros(min(2, m), U64), self.h[:-2])[:m]
            #: pattern of the one and of the two words before; 0: none
            self.patterns = np.where(np.stack([one, two], 1), np.stack([mix(h1 ^ U64(0xA5A5)), mix(h2 * U64(0x9E3779B97F4A7C15) + h1)], 1) | U64(1), U64(0)).view(np.int64)
        self.chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])

    def plain(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is a mention: holds a letter or digit; is a plain word) of words,
        punctuation around them aside."""
        data, a, b = self.s.data, self.s.start[words], self.s.end[words]
        digit = data - np.uint8(0x30) < 10
        letter = (data | np.uint8(0x20)) - np.uint8(0x61) < 26
        letters = np.concatenate([[0], np.cumsum(letter | (data >= 0x80))])
        digits = np.concatenate([[0], np.cumsum(digit)])
        n, m = letters[b] - letters[a], digits[b] - digits[a]
        first, last = np.searchsorted(letters, letters[a] + 1), np.searchsorted(letters, letters[b])
        return n + m > 0, (m == 0) & (n > 0) & (last - first + 1 == n)

    def word_at(self, doc: int, char: int) -> int:
        """The word of text ``doc`` in which its code point ``char`` stands."""
        byte = np.searchsorted(self.chars, self.chars[self.s.offsets[doc]] + char, "right") - 1
        return int(np.searchsorted(self.s.start, byte, "right")) - 1

    def begin(self, doc: int, word: int) -> int:
        return int(self.chars[self.s.start[word]] - self.chars[self.s.offsets[doc]])

    def mention(self, t: str, doc: int, word: int) -> tuple[int, int]:
        """What stands at ``word``, without punctuation around it; groups of
        digits behind one that holds a digit belong to it."""
        a = self.begin(doc, word)
        b = int(self.chars[self.s.end[word]] - self.chars[self.s.offsets[doc]])
        if any("0" <= c <= "9" for c in t[a:b]):
            while (m := _GROUP.match(t, b)) and "\n" not in t[b : m.start(1)]:
                b = m.end(1)
        own = t[a:b]
        return a + len(own) - len(own.lstrip(_TRIM)), b - (len(own) - len(own.rstrip(_TRIM)))


def _flagged(s: Slice) -> np.ndarray:
    """Which texts hold a digit or @: others have no seed."""
    upto = np.concatenate([[0], np.cumsum((s.data == 0x40) | (s.data - np.uint8(0x30) < 10))])[s.offsets]
    return np.diff(upto) > 0


_EDGES = "pattern long, k int, instance long, first long, kind int, plain boolean"
_EDGE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
SOME_MENTIONS = 1 << 18


def _edges(docs: DataFrame, text: str, wanted: Callable[[_Lines], np.ndarray] | None) -> DataFrame:
    """Distinct (pattern, k, instance, first, kind, plain) of mentions; kind: place in LEARNT.

    Without ``wanted``: of seeds.  Else of the words it marks: (words, 2), by
    pattern.  first: hash of the mention's first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found: set[tuple] = set()
            for x, _, s in slices(batch.column(0), SPACED_LOWER):
                if wanted is None:
                    texts = np.flatnonzero(_flagged(s))
                    lines, want = None, None
                else:
                    lines = _Lines(s)
                    want = wanted(lines)
                    texts = np.unique(np.searchsorted(s.first, np.flatnonzero(want.any(1)), "right") - 1)
                for i in texts.tolist():
                    t = batch.column(0)[x + i].as_py()
                    seeds = seed_spans(t)
                    if wanted is None and seeds and lines is None:
                        lines = _Lines(s)
                    taken = {lines.word_at(i, a): (LEARNT.index(kind), a, b) for kind, a, b in seeds}
                    words = taken if wanted is None else (np.flatnonzero(want[s.first[i] : s.first[i + 1]].any(1)) + s.first[i]).tolist()
                    for w in words:
                        kind, a, b = taken.get(w) or (None, *lines.mention(t, i, w))
                        if b > a:
                            for k in (0, 1):
                                if lines.patterns[w, k] and (wanted is None or want[w, k]):
                                    found.add((int(lines.patterns[w, k]), k, _id(t[a:b]), int(lines.h[w].view(np.int64)), kind, _plain(t[a:b])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(zip(*found, strict=True), _EDGE_TYPES, strict=True)], [c.split()[0] for c in _EDGES.split(", ")])

    return docs.select(text).mapInArrow(run, _EDGES).groupBy("pattern", "instance").agg(F.max("k").alias("k"), F.min("first").alias("first"), F.min("kind").alias("kind"), F.min("plain").alias("plain"))


def _filter(df: DataFrame, column: str) -> np.ndarray:
    """A filter over a column of longs, however many: about 64 bits a value, up
    to 2**MOST_BITS.  Its words are made in Spark; at most 2**20 of them come
    to the driver."""
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * df.count()).bit_length()))
    spread = F.xxhash64(column)
    word = spread.bitwiseAND(F.lit((1 << (bits - 6)) - 1)).alias("word")
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(spread, 58) as int))")
    rows = df.select(spread.alias("spread"), word).groupBy("word").agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for r in rows.toLocalIterator():
        out[r["word"]] = r["bits"]
    return out


def _xxhash64(x: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of longs, seed 42."""
    p1, p2, p3, p4, p5 = (U64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda v, r: v << U64(r) | v >> U64(64 - r)
    with np.errstate(over="ignore"):
        h = (U64(42) + p5 + U64(8)) ^ (turn(x.view(U64) * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ h >> U64(33)) * p2
        h = (h ^ h >> U64(29)) * p3
        return h ^ h >> U64(32)


def _passes(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    h = _xxhash64(np.ascontiguousarray(x).ravel())
    word = bits[(h & U64(len(bits) - 1)).astype(np.int64)].view(U64)
    return ((word >> (h >> U64(58)) & U64(1)) == 1).reshape(x.shape)


def _counts(docs: DataFrame, text: str, bits) -> DataFrame:
    """pattern, n, plain: mentions behind the patterns of a filter, and how
    many of them are plain words; summed in each task before they go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        have = 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            patterns, n, plain = (np.concatenate(x) for x in zip(*kept, strict=True))
            patterns, at = np.unique(patterns, return_inverse=True)
            return patterns, np.bincount(at, n).astype(np.int64), np.bincount(at, plain).astype(np.int64)

        for batch in batches:
            for _, _, s in slices(batch.column(0), SPACED_LOWER):
                lines = _Lines(s)
                word, k = np.nonzero((lines.patterns != 0) & _passes(bits.value, lines.patterns))
                mention, plain = lines.plain(word)
                kept.append((lines.patterns[word, k][mention], np.ones(int(mention.sum()), np.int64), plain[mention].astype(np.int64)))
                have += len(word)
                if have > SOME_MENTIONS:
                    kept = [merged()]
                    have = len(kept[0][0])
                    if have > SOME_MENTIONS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept[0]], ["pattern", "n", "plain"])
                        kept, have = [], 0
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], ["pattern", "n", "plain"])

    return docs.select(text).mapInArrow(run, "pattern long, n long, plain long").groupBy("pattern").agg(F.sum("n").alias("n"), F.sum("plain").alias("plain"))


def _candidates(docs: DataFrame, text: str, known: DataFrame, trusted: DataFrame | None, confidence: float, support: int) -> DataFrame:
    """pattern, kind with enough distinct known instances, not trusted yet,
    that stand before plain words seldom enough."""
    some = known.groupBy("pattern", "kind").agg(F.count_distinct("instance").alias("n")).where(F.col("n") >= support).select("pattern", "kind")
    some = written(some if trusted is None else some.join(trusted, ["pattern", "kind"], "left_anti"), "supported")
    if not some.limit(1).count():
        return some
    sent = docs.sparkSession.sparkContext.broadcast(_filter(some, "pattern"))
    seldom = _counts(docs, text, sent).where(F.col("plain") <= F.col("n") * (1 - confidence))
    return written(some.join(seldom.select("pattern"), "pattern", "left_semi"), "candidates")


def trusted_patterns(docs: DataFrame, text: str = "text", rounds: int = 3, confidence: float = 0.7, support: int = 3) -> DataFrame:
    """pattern (a hash), k (0: one word, 1: two), kind (place in LEARNT), confidence."""
    spark = docs.sparkSession
    seeds = written(_edges(docs, text, None), "seeds")
    known = seeds.select("instance", "kind", F.lit(1.0).alias("score")).groupBy("instance").agg(F.min(F.struct("kind", "score")).alias("x")).select("instance", "x.*")
    contexts = seeds.select("pattern", "instance", "kind")
    trusted = None
    for _ in range(rounds):
        wanted = _candidates(docs, text, contexts, trusted, confidence, support)
        if not wanted.limit(1).count():
            break
        sent = spark.sparkContext.broadcast(_filter(wanted, "pattern"))
        graph = _edges(docs, text, lambda lines, sent=sent: (lines.patterns != 0) & _passes(sent.value, lines.patterns)).join(wanted.select("pattern").distinct(), "pattern", "left_semi")
        graph = written(graph, "graph")
        total = graph.join(known.select("instance", F.col("kind").alias("own")), "instance", "left")
        total = total.groupBy("pattern").agg(F.max("k").alias("k"), F.sum(F.when(F.col("own").isNull() & ~F.col("plain"), 0.5).otherwise(1.0)).alias("total"))
        # no instance owes its score to a pattern that is still a candidate
        worth = graph.join(known.withColumnRenamed("kind", "own"), "instance")
        worth = worth.groupBy("pattern", F.col("own").alias("kind")).agg(F.sum("score").alias("worth"))
        scored = wanted.join(worth, ["pattern", "kind"]).join(total, "pattern").withColumn("confidence", F.col("worth") / F.greatest("total", "worth"))
        won = written(scored.where(F.col("confidence") >= confidence).select("pattern", "k", "kind", "confidence"), "trusted")
        trusted = won if trusted is None else trusted.unionByName(won)

        unknown = graph.where(~F.col("plain")).select("pattern", "instance", "first").join(known.select("instance"), "instance", "left_anti")
        doubt = F.sum(F.ln(1 - F.least("confidence", F.lit(0.999))))
        new = unknown.join(won, "pattern").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"), F.min("first").alias("first"))
        new = new.where(F.col("score") >= confidence).groupBy("instance").agg(F.max_by(F.struct("kind", "score", "first"), F.struct("score", "kind")).alias("x"))
        new = written(new.select("instance", "x.*"), "known")
        if not new.limit(1).count():
            break
        sent = spark.sparkContext.broadcast(_filter(new, "first"))
        met = _edges(docs, text, lambda lines, sent=sent: (lines.patterns != 0) & _passes(sent.value, lines.h.view(np.int64))[:, None])
        met = met.select("pattern", "instance").join(new.select("instance", "kind"), "instance").select("pattern", "instance", "kind")
        known = written(known.unionByName(new.select("instance", "kind", "score")), "known")
        contexts = written(contexts.unionByName(met), "contexts")
    return spark.createDataFrame([], "pattern long, k int, kind int, confidence double") if trusted is None else trusted


def _marked(plain: DataFrame, text: str, best: DataFrame, name: str) -> DataFrame:
    """``plain`` with ``name``: spans (start, end, kind) behind trusted
    patterns, by joins; for more patterns than a task can hold.  Equal texts
    are looked up once, by their hash."""
    by = name + "_by"
    sent = plain.sparkSession.sparkContext.broadcast(_filter(best, "pattern"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for x, _, s in slices(batch.column(0), SPACED_LOWER):
                lines = _Lines(s)
                want = (lines.patterns != 0) & _passes(sent.value, lines.patterns)
                found = []
                for w, k in zip(*(c.tolist() for c in np.nonzero(want)), strict=True):
                    i = int(np.searchsorted(s.first, w, "right")) - 1
                    a, b = lines.mention(batch.column(0)[x + i].as_py(), i, w)
                    found.append((batch.column(1)[x + i].as_py(), a, b, k, int(lines.patterns[w, k])))
                if found:
                    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), types, strict=True)], [by, "start", "end", "k", "pattern"])

    keyed = plain.withColumn(by, F.sha2(text, 256))
    sought = keyed.select(text, by).mapInArrow(run, f"`{by}` string, start int, end int, k int, pattern long")
    hits = sought.join(best, "pattern").groupBy(by, "start", "end").agg(F.max_by("kind", "k").alias("kind"))
    spans = hits.groupBy(by).agg(F.collect_list(F.struct("start", "end", "kind")).alias(name))
    return keyed.join(spans, by, "left").select(*(F.col(f"`{c}`") for c in plain.columns), name)


def find_pii(docs: DataFrame, text: str = "text", rounds: int = 3, confidence: float = 0.7, support: int = 3, replace: bool = False) -> DataFrame:
    """``docs`` with ``pii``: spans (kind, start, end, base) in code points,
    end exclusive, sorted by kind as in LEARNT, start and end.

    Base spans are the leftmost matches of each kind; base is false for what
    the method added (secrets that are seeds, and mentions behind trusted
    patterns), which never touches a base span.  A null text is empty.  Equal
    texts get equal spans, repeated rows are judged each, an empty table gives
    no rows; a column called ``pii`` is replaced, all others are kept.  With
    ``replace`` the text is redacted by them, as :func:`redact` does.
    """
    bounded_batches(docs.sparkSession)
    patterns = trusted_patterns(docs, text, rounds, confidence, support)
    best = patterns.groupBy("pattern").agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"))
    best = written(best, "best")
    plain = docs.drop("pii")
    few = best.limit(BLOCK + 1).count() <= BLOCK
    name = f"marked_{uuid.uuid4().hex}"  # no column of docs
    given = plain if few else _marked(plain, text, best, name)
    told = sorted((r["pattern"], r["kind"]) for r in best.collect()) if few else []
    sent = docs.sparkSession.sparkContext.broadcast((np.array([p for p, _ in told], np.int64), np.array([k for _, k in told], np.int64)))
    at, last = plain.columns.index(text), len(plain.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        trusted, kinds = sent.value
        for batch in batches:
            more = None if few else batch.column(last)
            for x, y, s in slices(batch.column(at), SPACED_LOWER):
                some = _flagged(s)
                marks: dict[int, dict[int, int]] = {}
                lines = None
                if len(trusted):
                    lines = _Lines(s)
                    for k in (0, 1):  # the pattern of two words goes first
                        place = np.minimum(np.searchsorted(trusted, lines.patterns[:, k]), len(trusted) - 1)
                        for w in np.flatnonzero(trusted[place] == lines.patterns[:, k]).tolist():
                            marks.setdefault(int(np.searchsorted(s.first, w, "right")) - 1, {})[w] = int(kinds[place[w]])
                out: list[list[dict]] = [[] for _ in range(y - x)]
                for i in range(y - x):
                    marked = more[x + i].as_py() if more is not None else None
                    if not (some[i] or i in marks or marked):
                        continue
                    t = batch.column(at)[x + i].as_py()
                    seeds = seed_spans(t) if some[i] else []
                    spans = [(LEARNT.index(k), a, b, k in KINDS) for k, a, b in seeds]
                    taken = sorted((a, b) for _, a, b in seeds)
                    found = [(z["kind"], z["start"], z["end"]) for z in marked or ()]
                    found += [(kind, *lines.mention(t, i, w)) for w, kind in sorted(marks.get(i, {}).items())]
                    for kind, a, b in sorted(found, key=lambda z: (z[1], z[2])):
                        if b > a and not _plain(t[a:b]) and not any(c < b and a < d for c, d in taken):
                            taken.append((a, b))
                            spans.append((kind, a, b, False))
                    out[i] = [{"kind": LEARNT[k], "start": a, "end": b, "base": own} for k, a, b, own in sorted(spans)]
                rows = batch.slice(x, y - x)
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([*rows.columns[:last], pa.array(out, kind)], [*rows.schema.names[:last], "pii"])

    whole = in_turn(run, _redactor(at, last)) if replace else run
    return given.mapInArrow(whole, plain.withColumn("pii", F.lit(None).cast(_SPAN)).schema)


def redact(docs: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """``docs`` with each span of ``spans`` in ``text`` replaced by its kind in
    brackets; spans that overlap become one, named by the first.  Rows without
    spans, and null texts, are unchanged; rows that share a key are redacted each."""
    return docs.mapInArrow(_redactor(docs.columns.index(text), docs.columns.index(spans)), docs.schema)


def _redactor(at: int, by: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(by).to_pylist()
            if not any(found):
                yield batch
                continue
            texts = batch.column(at).to_pylist()
            for i, own in enumerate(found):
                if own:
                    out, upto = [], 0
                    for s in sorted(own, key=lambda s: (s["start"], -s["end"])):
                        if s["start"] >= upto:
                            out += [texts[i][upto : s["start"]], f"[{s['kind'].upper()}]"]
                        upto = max(upto, s["end"])
                    texts[i] = "".join([*out, texts[i][upto:]])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return run
