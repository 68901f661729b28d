"""Token counts of whole texts, huge ones by overlap resynchronisation.

A huge text is encoded in overlapping chunks, with the offsets of the tokens
that begin where the pre-tokeniser provably cuts.  Two neighbouring
chunks are spliced at a boundary that both have, that the pre-tokeniser cuts
at in any context, and behind which both give the same ids up to the next such
cut.  Where the overlap holds none, it is widened, in the end to the chunk,
and then the chunk grows; so the outcome is the encoding of the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .encoding import encoder
from .state import bounded_batches
from .textcore import SPACED, slices

#: Cut before a space with a letter or digit of ASCII on either side: the
#: pre-tokeniser cuts there whatever stands further off, and no special token
#: holds a space.
STABLE = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")
#: ids, places in the text where tokens begin (all or some, rising), numbers of those tokens.
Encoded = tuple[np.ndarray, np.ndarray, np.ndarray]


def splice(text: str, encode: Callable[[str], Encoded], chunk: int = 16384, overlap: int = 256) -> Iterator[np.ndarray]:
    """Ids of ``text`` in order, chunk by chunk."""
    at, size = 0, chunk
    left = encode(text[:size])
    end = min(len(text), size)
    while end < len(text):
        wide, found = overlap, None
        while found is None:
            begin = max(at, end - wide)
            if begin > at:
                right = encode(text[begin : begin + chunk + wide])
                found = _common(text, left, at, right, begin, end)
            if found is None:
                if begin == at:
                    break
                wide *= 2
        if found is None:  # no boundary in the whole chunk: the chunk grows
            size *= 2
            left = encode(text[at : at + size])
            end = min(len(text), at + size)
            continue
        p, i, j = found
        yield left[0][:i]
        end = min(len(text), begin + chunk + wide)
        ids, places, numbers = right
        rest = np.searchsorted(places, p - begin)
        left, at, size = (ids[j:], places[rest:] + (begin - p), numbers[rest:] - j), p, chunk
    yield left[0]


def _common(text: str, left: Encoded, at: int, right: Encoded, begin: int, end: int) -> tuple[int, int, int] | None:
    """(position, token in the left chunk, token in the right) of a proven boundary."""
    cuts = np.array([m.start() for m in STABLE.finditer(text, begin, end)], np.int64)
    tokens = []
    for (_, places, numbers), base in ((left, at), (right, begin)):
        where = np.searchsorted(places, cuts - base)
        there = np.zeros(len(cuts), bool)
        inside = where < len(places)
        there[inside] = places[where[inside]] == (cuts - base)[inside]
        tokens.append(np.where(there, numbers[np.minimum(where, len(numbers) - 1)], -1) if len(numbers) else np.full(len(cuts), -1))
    both = (tokens[0] >= 0) & (tokens[1] >= 0)
    for k in np.flatnonzero(both[:-1] & both[1:]).tolist():
        (a, b), (c, d) = (x[k : k + 2].tolist() for x in tokens)
        if np.array_equal(left[0][a:b], right[0][c:d]):
            return int(cuts[k]), a, c
    return None


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, key: str = "doc_id", text: str = "text", huge: int = 8192, chunk: int = 8192, overlap: int = 256) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit of each row.

    Counts are the library's for the whole text, without added special tokens;
    special strings inside a text count as the library takes them by default.
    A text of more than ``huge`` bytes goes through :func:`splice`.  A null
    text counts as empty (0 tokens), a null key stays null, repeated rows are
    counted each, an empty table gives no rows, and other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)

        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            n_bytes = np.diff(off)
            n_tokens = np.zeros(len(texts), np.int64)
            long = np.flatnonzero(n_bytes > huge)
            for i in long.tolist():
                n_tokens[i] = sum(map(len, splice(texts[i].as_py(), enc.offsets, chunk, overlap)))
            rest = np.flatnonzero(n_bytes <= huge)
            for a, b, s in slices(texts.take(pa.array(rest)) if len(long) else texts, SPACED):
                n_tokens[rest[a:b]] = enc.encode(s.data, s.offsets)[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)], [key, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
