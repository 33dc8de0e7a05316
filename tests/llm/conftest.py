from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

VOCABULARY = [a + b for a in "ba ko ti mu re sa lo ne".split() for b in "lan dor mik ves pur tol gan his".split()]


def made_texts() -> list[str | None]:
    """Texts with edge cases, copies, near copies, repeated passages, licences and personal data."""
    rng = random.Random(7)

    def words(n: int) -> list[str]:
        return [rng.choice(VOCABULARY) for _ in range(n)]

    passage, other = words(60), words(35)
    base = words(400)
    near = list(base)
    near[200] = "changed"
    texts: list[str | None] = [
        None, "", "  \n\t ", "one", "one two", "one two three", "ONE Two\x0bthree", " wide space é",
        " ".join(base), " ".join(base), " ".join(near), "  ".join(base).upper(),
        " ".join(words(30) + passage + words(30)), " ".join(words(5) + passage + words(50)),
        " ".join(other), " ".join(words(3) + other + words(3)), " ".join(other[1:] + words(9)),
        " ".join(passage + passage), " ".join(["same"] * 200), " ".join(["a", "b"] * 60),
        "line one\nline one\n\n \nline two\nline one" + " filler" * 50,
        "Under the MIT License or the Apache-License, CC_BY and\nGNU General Public License v3 mit license",
        "submit license; mit licenses; Apache  license version 2.0 " + "x " * 60, "cc by-sa 4.0 is not cc byx",
        "Mail Ann@Corp.example or ann@corp.EXAMPLE, call +49 30 1234567, Mrs Ada Muster. " * 3,
        "card 4111 1111 1111 1111 ip 10.1.2.3 ssn 123-45-6789 Mr Karl Heinz password=geheim1 г-жа Иванова",
        "▁marked  text▁ with  runs   of spaces\nand\ttabs ́ 😀 ﻿", "#$%& | < > *" * 20,
        " ".join(words(5000)),
    ]
    texts += [" ".join(words(rng.randint(40, 300))) for _ in range(40)]
    texts += [" ".join(base)] * 20
    return texts


@pytest.fixture(scope="session")
def texts() -> list[str | None]:
    return made_texts()


@pytest.fixture(scope="session")
def tables(tmp_path_factory, texts) -> str:
    """A folder with the tables the queries read."""
    folder = tmp_path_factory.mktemp("tables")
    n = len(texts)
    pq.write_table(
        pa.table({
            "doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts, pa.string()),
            "lang": [["en", None][i % 7 == 6] for i in range(n)],
            "source": [None if i % 11 == 0 else f"src{min(i % 5, 3)}" for i in range(n)],
            "n_chars": pa.array([len(t or "") for t in texts], pa.int64()),
        }),
        folder / "documents.parquet",
    )
    return str(folder)


@pytest.fixture(scope="session")
def empty_tables(tmp_path_factory, tables) -> str:
    folder = tmp_path_factory.mktemp("empty")
    pq.write_table(pq.read_table(f"{tables}/documents.parquet").slice(0, 0), folder / "documents.parquet")
    for name, fields in {
        "conversations": [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())],
        "pages": [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())],
        "benchmark": [("item_id", pa.int64()), ("text", pa.string())],
        "embeddings": [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32()))],
    }.items():
        pq.write_table(pa.schema(fields).empty_table(), folder / f"{name}.parquet")
    return str(folder)
