"""Byte-level BPE by tiktoken with a local rank file."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skydrift.llm.words import column, read

#: Texts above this many characters are cut at safe places before encoding.
CHUNK_CHARS = 65_536
#: A longer run of white space exhausts the stack of the library's matcher.
LONG_RUN = 16_384

_SPACE = r"\t-\r \x85\xa0  -     　"
#: Here one match of the split pattern ends and another begins, whatever comes
#: before or after: a letter or digit and then ASCII of another class, or
#: anything but white space and then a blank or line feed.
_SAFE = regex.compile(rf"(?<=[A-Za-z])(?=[\x00-@\[-`{{-\x7f])|(?<=[0-9])(?=[\x00-/:-\x7f])|(?<=[^{_SPACE}])(?=[ \n])")
_RUN = regex.compile(rf"[{_SPACE}]{{{LONG_RUN},}}")


class Codec:
    """Encodes by ``ranks`` (token bytes to id) and a split pattern that treats
    white space as the patterns of this family do (``\\s+(?!\\S)|\\s+`` last)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._pattern = regex.compile(pattern)
        self._tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self._tokens[i] = token

    def _plain(self, text: str, out: list[np.ndarray]) -> None:
        at = 0
        while len(text) - at > CHUNK_CHARS:
            cut = _SAFE.search(text, at + CHUNK_CHARS)
            if cut is None:
                break
            out.append(self._numbers(text[at: cut.start()]))
            at = cut.start()
        out.append(self._numbers(text[at:]))

    def _numbers(self, text: str) -> np.ndarray:
        return np.array(self._encoding.encode_ordinary(text), "<u4")

    def encode(self, text: str) -> np.ndarray:
        """The ids of the whole text, as the library gives them for each match
        of the pattern by itself."""
        if len(text) <= min(CHUNK_CHARS, LONG_RUN):
            return self._numbers(text)
        out: list[np.ndarray] = []
        at = 0
        for run in _RUN.finditer(text):
            # a run is one match, but for its last character if text follows
            end = run.end() if run.end() == len(text) else run.end() - 1
            if at < run.start():
                self._plain(text[at: run.start()], out)
            out.append(np.array(self._encoding._core_bpe.encode_single_piece(run.group()[: end - run.start()].encode()), "<u4"))
            at = end
        if at < len(text):
            self._plain(text[at:], out)
        return np.concatenate(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The raw bytes of the ids, also where they are no whole characters."""
        return b"".join([self._tokens[i] for i in ids.tolist()])


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def codec(ranks: bytes, pattern: str) -> Codec:
    lines = map(bytes.split, ranks.splitlines())
    return Codec({base64.b64decode(a): int(b) for a, b in lines}, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",),
           decoded: bool = False) -> DataFrame:
    """``keep``, ``ids`` (binary: little-endian unsigned 32-bit) and, if asked
    for, ``decoded`` (binary: what the ids decode to).

    A narrow pass: nothing is shuffled. The driver reads the rank file (under
    1 MB, fixed) and broadcasts it. A null text is empty; an empty text has no
    ids. Nulls, ties and repeated rows in ``keep`` pass through; other columns
    are not read."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    source, text = read(docs, keep)
    schema = source.select(*source.columns[:len(keep)], F.lit(b"").alias("ids"), *([F.lit(b"").alias("decoded")] * decoded)).schema

    def run(batches):
        own = codec(ranks.value, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids = [own.encode(t or "") for t in column(part, text).to_pylist()]
                made = [pa.array([x.tobytes() for x in ids], pa.binary())]
                if decoded:
                    made.append(pa.array([own.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *made], schema.names)

    return source.mapInArrow(run, schema)
