"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model has a whitespace marker after another character, so no
merge crosses the start of a marked word and the segmentation of a text is that
of its marked words, one after the other. Each task keeps a table of distinct
marked words, has the library segment every new one once, and joins the ids back
by position. The table holds at most ``TABLE_ENTRIES`` words and starts anew
beyond that, and texts leave a batch in groups of ``GROUP_BYTES``, so a task
holds little besides its batch whatever the vocabulary; results depend on
neither. A corpus-wide table would have to shuffle every word of every text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rowbridge.common import column

MARK = "▁"
TABLE_ENTRIES = 250_000
# Texts are handled in groups of about this many bytes.
GROUP_BYTES = 250_000
_CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def load(path: str) -> bytes:
    """The model, to be sent with the tasks; executors need no file."""
    model = Path(path).read_bytes()
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    for i in range(processor.get_piece_size()):
        if MARK in processor.id_to_piece(i).lstrip(MARK):
            raise ValueError("pieces of this model cross whitespace markers")
    if processor.encode("a  b ", out_type=str)[0][0] != MARK or processor.decode(processor.encode("a  b ")) != "a  b ":
        raise ValueError("this model does not mark every space")
    return model


class Segmenter:
    """Ids of texts by way of distinct marked words."""

    def __init__(self, model: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        # Ids as the bytes of 32-bit integers: a third of the memory of tuples.
        self.table: dict[str, bytes] = {}
        self.lone_mark = array("i", [self.library.piece_to_id(MARK)]).tobytes()
        self.end = array("i", [self.library.eos_id()]).tobytes()

    def chunks(self, text: str) -> list[str]:
        """The marked words of a text, each without its first marker."""
        if not text:
            return []
        plain = text.split(" ")
        if "" not in plain and MARK not in text:
            return plain
        return [c[1:] for c in _CHUNKS.findall(MARK + text.replace(" ", MARK))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """All ids, and where each text's ids end; every text ends with the end id."""
        parts = [self.chunks(t) for t in texts]
        new = set(chain.from_iterable(parts))
        if len(self.table) + len(new) > TABLE_ENTRIES:
            self.table.clear()
        table = self.table
        new = [c for c in new if c not in table]
        for chunk, ids in zip(new, self.library.encode(new, num_threads=1), strict=True):
            table[chunk] = array("i", ids).tobytes()
        if "" in table:
            table[""] = self.lone_mark
        found = [b"".join([*map(table.__getitem__, part), self.end]) for part in parts]
        ends = list(accumulate(len(f) // 4 for f in found))
        return np.frombuffer(b"".join(found), dtype=np.int32), ends


def _groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n or 0
        if size >= GROUP_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(
    docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """All columns but the text, the ids of the text, and on demand the text they decode to.

    A null text counts as empty: it has the end id only and decodes to the empty
    text. An input column named as an output gives way to it.
    """
    outputs = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if decoded:
        outputs.append(T.StructField(decoded, T.StringType()))
    taken = {text.lower(), *(f.name.lower() for f in outputs)}
    rest = [f for f in docs.schema.fields if f.name.lower() not in taken]
    schema = T.StructType([*rest, *outputs])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(model)
        for batch in batches:
            for start, end in _groups(batch.column(0)):
                texts = [t or "" for t in batch.column(0).slice(start, end - start).to_pylist()]
                flat, ends = segmenter.encode(texts)
                made = [pa.ListArray.from_arrays(np.array([0, *ends], dtype=np.int32), flat)]
                if decoded:
                    lists = [ids.tolist() for ids in np.split(flat, ends[:-1])]
                    made.append(pa.array(segmenter.library.decode(lists, num_threads=1), pa.string()))
                kept = [c.slice(start, end - start) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    return docs.select(column(text).cast("string").alias("__text"), *[column(f.name) for f in rest]).mapInArrow(
        run, schema
    )


def decode(encoded: DataFrame, model: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """Set ``text`` to what the library decodes the ids to; null ids give the empty text."""
    rest = [f for f in encoded.schema.fields if f.name.lower() != text.lower()]
    schema = T.StructType([*rest, T.StructField(text, T.StringType())])
    place = [f.name for f in rest].index(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            lists = [x or [] for x in batch.column(place).to_pylist()]
            texts = library.decode(lists, num_threads=1) if lists else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(*[column(f.name) for f in rest]).mapInArrow(run, schema)
