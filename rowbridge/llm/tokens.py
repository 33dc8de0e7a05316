"""Token counts by way of a digest cache: no content is tokenized twice.

A text is normalised as far as its tokenizer provably ignores the difference,
and known by the SHA-256 of the result. Stored counts are looked up by that
digest below a folder of the tokenizer's version (a digest of its file, library
and settings); one row of every content that is not stored is encoded, and the
counts are appended to the folder. Texts move once, to the task that encodes
them; all joins after that are between digests.

A tokenizer that drops white space never joins words, so a text counts as the
sum of its words; each task then has the library encode a word once, in a table
of bounded size that results do not depend on.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path
from string import ascii_uppercase

import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowbridge.common import column, stage
from rowbridge.llm.common import put, row_key, text_or_empty, unused

TABLE_ENTRIES = 500_000
# Longer words are encoded each time they come, so the table's memory is bounded.
WORD_CHARS = 64
# Texts are handled in groups of about this many characters.
GROUP_CHARS = 2_000_000
# So many contents of a task are remembered: rows equal in every column come to one task.
REMEMBERED = 100_000
# White space that a text is cut and normalised at.
SPACES = "\t\n\x0b\x0c\r "


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file as it travels with the tasks."""

    library: str
    data: bytes
    # True when white space only parts words: runs of it count as one space, ends do not count.
    drops_space: bool = False
    # True when A-Z and a-z are the same to it outside its special strings, which are all ``specials``.
    ignores_case: bool = False
    specials: tuple[str, ...] = ()

    @property
    def version(self) -> str:
        made = {"tokenizers": tokenizers.__version__, "sentencepiece": sentencepiece.__version__}[self.library]
        told = f"{self.library} {made} spaces={self.drops_space} case={self.ignores_case} special=default "
        return hashlib.sha256(told.encode() + self.data).hexdigest()

    def open(self):
        """A function from texts to their numbers of tokens, by the library."""
        if self.library == "sentencepiece":
            pieces = sentencepiece.SentencePieceProcessor(model_proto=self.data)
            return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        bpe = _whole(self.data)
        return lambda texts: [len(e.ids) for e in bpe.encode_batch_fast(texts, add_special_tokens=False)]


def _whole(data: bytes) -> tokenizers.Tokenizer:
    made = tokenizers.Tokenizer.from_str(data.decode())
    made.no_truncation()
    made.no_padding()
    return made


def _of_json(data: bytes) -> Tokenizer:
    """What the file's steps and the library show: if white space and case count."""
    told = json.loads(data)
    steps = told.get("normalizer") or {}
    kinds = {s["type"] for s in steps.get("normalizers", [steps] if steps else [])}
    cut = told.get("pre_tokenizer") or {}
    first = (cut.get("pretokenizers") or [cut])[0]
    keeps_matches = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    added = told["added_tokens"]
    wide = [t for t in added if t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(SPACES)]
    if not kinds <= {"NFC", "NFKC", "Lowercase", "Replace"} or not keeps_matches or wide:
        return Tokenizer("tokenizers", data)
    bpe = _whole(data)

    def ids(text: str) -> list[int]:
        return bpe.encode(text, add_special_tokens=False).ids

    parts = ["ab", "'s", "12", "!?", "é", "́x", "<|endoftext|>"]
    apart = all(ids(a + s + s + b) == ids(a) + ids(b) for s in SPACES for a in parts for b in parts)
    drops = apart and not any(ids(s * 2) for s in SPACES)
    alike = "Lowercase" in kinds and all(ids(c) == ids(c.lower()) for c in ascii_uppercase)
    return Tokenizer("tokenizers", data, drops, alike, tuple(t["content"] for t in added))


def load(path: str) -> Tokenizer:
    """The tokenizer of a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file."""
    data = Path(path).read_bytes()
    if path.endswith(".json"):
        return _of_json(data)
    if path.endswith(".model"):
        return Tokenizer("sentencepiece", data)
    raise ValueError(f"not a tokenizer file: {path}")


class Counts:
    """Numbers of tokens of texts."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenizer = tokenizer
        self.count = tokenizer.open()
        self.table: dict[str, int] = {}

    def _words(self, text: str) -> list[str]:
        if self.tokenizer.ignores_case and text.isascii():
            low = text.lower()
            if not any(s in low for s in self.tokenizer.specials):
                text = low
        return text.split(" ")

    def of(self, texts: list[str]) -> list[int]:
        if not self.tokenizer.drops_space:
            return self.count(texts)
        parts = list(map(self._words, texts))
        needed = set(chain.from_iterable(parts))
        if len(self.table) + len(needed) > TABLE_ENTRIES:
            self.table.clear()
        table = self.table
        new = [w for w in needed if w not in table]
        for i in range(0, len(new), 8192):
            some = new[i : i + 8192]
            table.update(zip(some, self.count(some), strict=True))
        counted = [sum(map(table.__getitem__, p)) for p in parts]
        for w in new:
            if len(w) > WORD_CHARS:
                del table[w]
        return counted


def normalised(text: Column, tokenizer: Tokenizer) -> Column:
    """The text with runs of white space as one space and none at its ends, where these do not count."""
    return F.trim(F.regexp_replace(text, f"[{SPACES}]+", " ")) if tokenizer.drops_space else text


def encode_contents(contents: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(digest, n_tokens) of (digest, content); a digest that a task meets again is left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = Counts(tokenizer), set()
        for batch in batches:
            digests, texts = batch.column(0).to_pylist(), batch.column(1)
            new, chars = [], 0
            for i, d in enumerate(digests):
                if d in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(d)
                new.append(i)
                chars += len(texts[i].as_py())
                if chars >= GROUP_CHARS:
                    yield counted(counts, digests, texts, new)
                    new, chars = [], 0
            if new:
                yield counted(counts, digests, texts, new)

    def counted(counts: Counts, digests: list[bytes], texts: pa.Array, rows: list[int]) -> pa.RecordBatch:
        numbers = counts.of([texts[i].as_py() for i in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array([digests[i] for i in rows], pa.binary()), pa.array(numbers, pa.int64())], names=["digest", "n_tokens"]
        )

    return contents.mapInArrow(run, "digest binary, n_tokens long")


def stored_counts(spark: SparkSession, cache: str, tokenizer: Tokenizer) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; empty where nothing is stored."""
    folder = f"{cache.rstrip('/')}/version={tokenizer.version}"
    schema = "digest binary, n_tokens long"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    # Two runs at once may have stored the same content: the counts are equal.
    return spark.read.schema(schema).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, cache: str, text: str = "text") -> DataFrame:
    """All columns but the text, with ``n_bytes`` (UTF-8) and ``n_tokens``, both long.

    ``cache`` is a folder all executors share; counts of new contents are
    appended to it. A null text counts as empty: no bytes, no tokens. Input columns named as an output
    give way to it. Copies, in whatever number, are encoded once; equal rows are
    each returned. An empty table adds nothing. Begin, end and other special
    tokens are not added; their strings in a text are what the library makes of
    them by default. The version is part of the path, so another tokenizer,
    library or setting never meets these counts.
    """
    spark = docs.sparkSession
    names = [*docs.columns, "n_bytes", "n_tokens"]
    digest, h1, h2 = (unused(names, n) for n in ("digest", "h1", "h2"))
    content = normalised(text_or_empty(text), tokenizer)
    key = F.unhex(F.sha2(content, 256))
    first, second = row_key(docs)
    kept = [c for c in docs.columns if c.lower() not in (text.lower(), "n_bytes", "n_tokens")]
    keyed = stage(
        docs.select(
            *[column(c) for c in kept],
            F.octet_length(text_or_empty(text)).cast("long").alias("n_bytes"),
            key.alias(digest), first.alias(h1), second.alias(h2),
        ),
        "token-digests",
    )
    contents = keyed.groupBy(F.col(digest).alias("digest")).agg(F.min(F.struct(h1, h2)).alias("k"))
    missing = contents.join(stored_counts(spark, cache, tokenizer), "digest", "left_anti")
    chosen = missing.select(F.col(f"k.{h1}").alias("h1"), F.col(f"k.{h2}").alias("h2"))
    texts = docs.select(first.alias("h1"), second.alias("h2"), text_or_empty(text).alias("text"))
    texts = texts.join(chosen, ["h1", "h2"], "left_semi").select(normalised(F.col("text"), tokenizer).alias("content"))
    new = encode_contents(texts.select(F.unhex(F.sha2("content", 256)).alias("digest"), "content"), tokenizer)
    new.write.mode("append").parquet(f"{cache.rstrip('/')}/version={tokenizer.version}")
    counts = stored_counts(spark, cache, tokenizer).select(F.col("digest").alias(digest), "n_tokens")
    return put(keyed.join(counts, digest).drop(digest, h1, h2), n_tokens=F.col("n_tokens"))
