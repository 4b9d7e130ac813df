"""Token counts by overlap resynchronisation.

A document of up to ``chunk`` characters is encoded at once.  A longer one is encoded in overlapping chunks.
Offsets of the tokens of two neighbouring chunks give the boundaries both have in their overlap; they are
spliced at one that is proven stable, and where there is none the overlap is widened (in the end to the
whole rest of the document, so the count is always that of the whole text).

What is proven: the encoder joins neighbouring symbols only if their text is a piece.  A boundary between
characters c and d is never crossed if no piece of the vocabulary holds "cd"; then nothing left of it can
depend on what is right of it, nor the other way round.

Null and empty texts have no tokens.  Special strings inside a text are ordinary text, as the library's default.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from tidemark.llm.batches import in_batches, slices

CHUNK = 16_384
OVERLAP = 256
SPACE = "▁"  # stands for a space in pieces


class Counter:
    """A loaded model with the facts that splicing needs.

    The model must be of the byte-pair kind, keep the text as it is but for a space put before it, and spell
    unknown characters in bytes; the constructor checks this on a few strings.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        single = [self.model.is_byte(i) for i in range(len(pieces))]
        # bytes of text, with spaces written as SPACE, that a token of each id covers
        self.width = np.array([1 if b else len(p.encode()) for p, b in zip(pieces, single)])
        self.joined = {p[i:i + 2] for p, b in zip(pieces, single) if not b for i in range(len(p) - 1)}
        for probe in (" a  b ", "éﬁ　x\n\ty", "▁▁ z", "<s>a</s>"):
            if int(self.width[self.ids(probe)].sum()) != len((SPACE + self.shown(probe)).encode()):
                raise ValueError("the model changes its texts; chunks cannot be aligned")

    @staticmethod
    def shown(text: str) -> str:
        return text.replace(" ", SPACE)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), dtype=np.int64)

    def _chunk(self, text: str, begin: int, end: int, at_start: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of text[begin:end] and where each token ends, in bytes of the shown text from ``begin`` on.

        The model puts a space before every chunk.  Other chunks than the first begin right after a character
        that no piece joins to a space, and the tokens of that foreign space are cut off by the splice.
        """
        ids = self.ids(text[begin:end])
        lead = len(SPACE.encode())
        return ids, np.cumsum(self.width[ids]) - lead

    def count(self, text: str | None, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        if not text:
            return 0
        if len(text) <= chunk:
            return len(self.model.encode(text, num_threads=1))
        total, begin = 0, 0
        ids, ends = self._chunk(text, 0, chunk, True)
        end, done = chunk, 0  # the current chunk is text[begin:end]; its tokens before ``done`` are counted
        while end < len(text):
            width = overlap
            while True:
                start = max(begin + 1, end - width)
                stop = min(len(text), end + chunk)
                nxt_ids, nxt_ends = self._chunk(text, start, stop, False)
                shift = len(self.shown(text[begin:start]).encode())
                splice = self._splice(text, start, end, ends - shift, nxt_ends, ends[done - 1] - shift if done else -1)
                if splice is not None:
                    break
                if start == begin + 1:  # the overlap is the whole chunk: take it with as much again as one
                    stop = min(len(text), 2 * end - begin + chunk)
                    ids, ends = self._chunk(text, begin, stop, begin == 0)
                    if begin:
                        done = self._after(ends, resumed)
                    end = stop
                    width = 0
                    break
                width *= 4
            if width:
                here = int(np.searchsorted(ends - shift, splice, side="right"))
                total += here - done
                begin, end, ids, ends, resumed = start, stop, nxt_ids, nxt_ends, splice
                done = self._after(ends, splice)
        return total + len(ids) - done

    @staticmethod
    def _after(ends: np.ndarray, splice: int) -> int:
        return int(np.searchsorted(ends, splice, side="right"))

    def _splice(self, text: str, start: int, end: int, left: np.ndarray, right: np.ndarray, after: int) -> int | None:
        """The last stable boundary, in bytes from ``start`` on, that both chunks have in text[start:end]."""
        shown = self.shown(text[start:end])
        sizes = np.frombuffer(shown.encode("utf-32-le"), dtype="<u4")
        at = np.cumsum(1 + (sizes > 0x7F) + (sizes > 0x7FF) + (sizes > 0xFFFF))  # where each character ends
        common = np.intersect1d(left, right)
        inner = np.flatnonzero(np.isin(at[:-1], common[common > after]))
        for i in inner[::-1].tolist():
            if shown[i:i + 2] not in self.joined:
                return int(at[i])
        return None


@functools.lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """Kept by a Python worker for its next task."""
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The documents with the number of their tokens instead of their text (a column named ``out`` is replaced).

    ``path`` names the model on every executor.  All further columns pass through, repeated rows too.
    """
    kept = [f for f in docs.schema.fields if f.name != text and f.name.lower() != out.lower()]
    at = docs.columns.index(text)
    picked = [docs.columns.index(f.name) for f in kept]
    schema = T.StructType([*kept, T.StructField(out, T.LongType())])

    def run(batches):
        model = counter(path)
        for batch in batches:
            for part in slices(batch):
                counts = pa.array([model.count(x, chunk, overlap) for x in part.column(at).to_pylist()], type=pa.int64())
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in picked], counts], [f.name for f in schema.fields])

    return in_batches(docs).mapInArrow(run, schema)
