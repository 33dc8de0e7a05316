"""Token counts, reversed search and collocations against plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rowbridge.llm import phrases, queries, search, tokens

AWKWARD = [
    None, "", " \t\n", "\x0b a\x0cb \x1c c d　e\x85f", "<|startoftext|> A <|ENDOFTEXT|><|endoftext|>x <|endoftext|>",
    "it's IT'S don't 'S 123 4.5 İSTANBUL ΣΑΣ é é ﬁ", "word " * 3000, "x" * 5000, "a  b\r\n\tc", "a b c", " a b c ",
]


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_token_counts_are_the_librarys(spark, tables, texts):
    library = Tokenizer.from_file(queries.word_tokenizer())
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_token_counts"](spark, tables).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        r = got[i]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((text or "").encode()), n, n > 2048)


@pytest.mark.parametrize("kind", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_of_awkward_texts(spark, tmp_path, kind):
    import public_tokenizers

    path = public_tokenizers.path(kind)
    library = sentencepiece.SentencePieceProcessor(model_file=path) if kind.endswith("model") else Tokenizer.from_file(path)
    docs = documents(spark, [(i, t, None) for i, t in enumerate(AWKWARD)])
    tokenizer = tokens.load(path)
    assert tokenizer.drops_space == (kind == "word_bpe_49k.json")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs, tokenizer, str(tmp_path)).collect()}
    for i, t in enumerate(AWKWARD):
        told = library.encode(t or "") if kind.endswith("model") else library.encode(t or "", add_special_tokens=False).ids
        assert got[i] == len(told), (i, t)


def test_token_cache_encodes_distinct_misses_only(spark, tmp_path):
    tokenizer, cache = tokens.load(queries.word_tokenizer()), str(tmp_path)

    def stored():
        return spark.read.parquet(f"{cache}/version={tokenizer.version}").count()

    first = documents(spark, [(1, "one two", "a"), (2, " one\ttwo\n", "b"), (2, " one\ttwo\n", "b"), (None, None, None), (4, "", None)])
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in tokens.count_tokens(first, tokenizer, cache).collect())
    assert got == [(0, 0, 0), (1, 7, 2), (2, 9, 2), (2, 9, 2), (4, 0, 0)] and stored() == 2
    # Stored counts are used, not made again: a wrong one shows.
    spark.read.parquet(f"{cache}/version={tokenizer.version}").selectExpr("digest", "n_tokens + 40 as n_tokens").write.parquet(f"{cache}/x")
    other = str(tmp_path / "other")
    spark.read.parquet(f"{cache}/x").write.parquet(f"{other}/version={tokenizer.version}")
    second = documents(spark, [(1, "one two", "a"), (5, "three", None)])
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(second, tokenizer, other).collect()} == {1: 42, 5: 1}
    tokens.count_tokens(second, tokenizer, cache)
    assert stored() == 3
    tokens.count_tokens(second.limit(0), tokenizer, cache)
    assert stored() == 3
    bytewise = tokens.load(queries.piece_model())
    assert bytewise.version != tokenizer.version
    assert tokens.count_tokens(second, bytewise, cache).count() == 2 and stored() == 3


def test_token_counts_with_clashing_names(spark, tmp_path):
    names = ["N_TOKENS", "n_bytes", "digest", "h1", "H2", "content", "k"]
    docs = spark.createDataFrame([("one two", *range(7))], ["text", *names])
    (got,) = tokens.count_tokens(docs, tokens.load(queries.word_tokenizer()), str(tmp_path)).collect()
    assert got.asDict() == {"digest": 2, "h1": 3, "H2": 4, "content": 5, "k": 6, "n_bytes": 7, "n_tokens": 2}


# ------------------------------------------------------------------ reversed search


def ranked(docs, items, k):
    """Plain scores over every document."""
    told = [(d, re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower(t or ""))) for d, t in docs]
    told = [(d, Counter(w), len(w)) for d, w in told if w]
    n_docs, n_terms = len(told), sum(n for _, _, n in told)
    df = Counter(w for _, c, _ in told for w in c)
    out = []
    for item, text in items.items():
        asked = Counter(re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower(text)))
        scored = []
        for d, c, n in told:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m))
                for w, times in asked.items() if c[w]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return out


DOCS = [
    (1, "The cat, the CAT and the dog"), (2, "the cat, the cat and the dog"), (2, "the cat, the cat and the dog"), (None, "dog éÉ x9"),
    (5, None), (6, ""), (7, "--- !!"), (8, "Éé" + " dog" * 4000), (-3, "the cat, the cat and the dog"), (None, "a_b a-b"),
    (11, "x" * 30000 + " cat\x00cat"),
]


def test_reversed_search(spark, monkeypatch):
    items = {0: "CAT dog dog unknown", 4: "éé x9 b", 5: "", 6: "the the", -1: "a b cat"}
    docs = spark.createDataFrame([(*d, "e") for d in DOCS], "doc_id long, text string, item_id string")
    asked = spark.createDataFrame(list(items.items()) + [(5, None)], "item_id long, text string")
    for block in (search.BLOCK_POSTINGS, 2):
        monkeypatch.setattr(search, "BLOCK_POSTINGS", block)
        for k in (1, 3, 50):
            got = [tuple(r) for r in search.rank_documents(docs, asked, k).collect()]
            assert sorted(got, key=repr) == sorted(ranked([d[:2] for d in DOCS], items, k), key=repr)


def test_reversed_search_of_many(spark):
    rng = np.random.default_rng(2)
    words = np.array([f"w{i}" for i in range(60)])
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(1, 30)))) for i in rng.permutation(700)]
    docs += [(1000 + i, docs[0][1]) for i in range(300)]
    items = {i: " ".join(rng.choice(words, 6)) for i in range(12)}
    got = search.rank_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(list(items.items()), "item_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(ranked(docs, items, 20))
    # Items of one id are one item.
    two = spark.createDataFrame([(1, "w1 w2"), (1, "w2")], "item_id long, text string")
    got = search.rank_documents(spark.createDataFrame(docs, "doc_id long, text string"), two)
    assert sorted(tuple(r) for r in got.collect()) == sorted(ranked(docs, {1: "w1 w2 w2"}, 20))


def test_reversed_search_of_nothing(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert search.rank_documents(docs.limit(0), items).collect() == []
    assert search.rank_documents(docs, items.limit(0)).collect() == []


# ------------------------------------------------------------------ collocations


def mined(rows, least, first):
    """All phrases by plain counting."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            told = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(told)
            counts[lang].update(tuple(told[i : i + k]) for k in range(1, 6) for i in range(len(told) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {g: n for g, n in f.items() if len(g) > 1 and n >= least}
        found = []
        for g, a in often.items():
            if any(len(h) > len(g) and n >= a and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, n in often.items()):
                continue
            score, _, l, r = min((1000 * a * total[lang] // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def made_rows():
    rng = np.random.default_rng(4)
    word = np.array(["The", "cat", "SAT", "on", "é", "Ünd", "mat", "x" * 80, "x" * 81, "a-b", "1", "\x1c"])
    rows = [("".join(f"{w}{m}" for w, m in zip(rng.choice(word, n), rng.choice([" ", "  ", "\t", ", ", ".", "\n"], n, p=[0.6, 0.1, 0.1, 0.1, 0.05, 0.05]))), lang)
            for n in rng.integers(1, 40, 120) for lang in ("en", "de", None)]
    return rows + [("one fixed line of words stands here", "en")] * 30 + [(None, "en"), ("", None), (" ;, ", "nothing"), ("word " * 400, "de")] + [("und", "und")] * 3


def test_collocations(spark):
    rows = made_rows()
    docs = spark.createDataFrame([(t, lang, 1, 2) for t, lang in rows], "text string, lang string, n long, id long").repartition(5)
    expected = mined(rows, 8, 40)
    assert len(expected) > 60 and {r[0] for r in expected} >= {"en", "de", "und"}
    assert sorted(tuple(r) for r in phrases.collocations(docs, least=8, first=40).collect()) == expected
    # Small tables, filters, shards and dictionaries change nothing.
    small = phrases.Limits(table_words=3, block_words=4, chunk_ids=20, filter_rows=50, filter_kept=10, least_shards=2, shard_rows=10, pair_bits=7)
    assert sorted(tuple(r) for r in phrases.collocations(docs, least=8, first=40, limits=small).collect()) == expected


def test_collocations_of_nothing(spark):
    docs = documents(spark, [(1, None, None), (2, "", "en"), (3, "a b", "en")])
    assert phrases.collocations(docs).collect() == []
    assert phrases.collocations(docs.limit(0)).collect() == []
    assert [tuple(r) for r in phrases.collocations(docs, least=1).collect()] == [("en", 1, "a b", 1, 1, 1, 2, 2000)]


@pytest.mark.parametrize("bits", [1, 5, 13, 21, 31])
def test_filters_are_lossless(bits):
    rng = np.random.default_rng(bits)
    for length in range(2, 6):
        grams = rng.integers(1, 1 << bits, (500, length), dtype=np.int64).astype(np.int32) if bits > 1 else np.ones((500, length), dtype=np.int32)
        grams = np.concatenate([grams, grams[:100]])
        kind = phrases.Filter(length, bits)
        limbs, counts = kind.merged(kind.pack([grams[:, i] for i in range(length)]), np.ones(len(grams), dtype=np.int64))
        limbs, counts = kind.loaded(kind.dumped(limbs, counts))
        got = dict(zip(map(tuple, kind.unpack(limbs).tolist()), counts.tolist(), strict=True))
        assert got == Counter(map(tuple, grams.tolist())) and len(limbs) == kind.n_limbs
        shards = kind.shards(limbs, min(bits, 3))
        assert (np.diff(shards.astype(np.int64)) >= 0).all() and shards.max() < 8


def test_exact_arithmetic_past_64_bits(spark):
    """The score of large counts, as the operator's SQL computes it."""
    con = duckdb.connect()
    a, n, left, right = 10**12, 10**14, 3 * 10**12, 7 * 10**12
    assert con.execute(f"select (1000::hugeint * {a} * {n}) // ({left}::hugeint * {right})").fetchone()[0] == 1000 * a * n // (left * right)
    given = spark.createDataFrame([(a, n, left, right)], "a long, total long, l long, r long")
    assert given.select(phrases.score_of("a", "total", "l", "r").alias("s")).head()[0] == 1000 * a * n // (left * right)


@pytest.mark.parametrize("name", ["op12_reversed_search", "op13_collocations"])
def test_the_sql_agrees(spark, tmp_path, name):
    """The registered query and its SQL on rows that reach the least count."""
    rows = made_rows() * 12
    pq.write_table(
        pa.table({"doc_id": pa.array(range(len(rows)), pa.int64()), "text": [t for t, _ in rows], "lang": [x for _, x in rows]}), tmp_path / "documents.parquet"
    )
    pq.write_table(pa.table({"item_id": pa.array([3, 4], pa.int64()), "text": ["the cat é", "fixed line mat"]}), tmp_path / "benchmark.parquet")
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
    got = queries.QUERIES[name](spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.execute(queries.SQL[name]).fetchall()) and got.count() > 30
