"""A small table of documents with every odd case, and plain-Python versions of the shared rules."""

from __future__ import annotations

import re
import zlib

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

SCHEMA = """doc_id long, text string, lang string, source string, n_chars long, row string, kept string,
text_sha256 string, score string, part string, rank string, words string, spans string, length string"""


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def in_fold(doc_id: int | None, folds: int) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % folds == 0


def rows(n: int = 80) -> list[tuple]:
    table = pq.read_table(f"{SMALL}/documents.parquet").slice(0, n).to_pylist()
    found = [(r["doc_id"], r["text"], r["lang"]) for r in table]
    base = next(t for _, t, _ in found if len(t) > 1500)
    odd = [
        None,
        "",
        " \n\t ",
        "word",
        "WORD",
        "Don't 'RE 'tis ''s x'll",
        "<|endoftext|> a <|startoftext|>b <| |>",
        "tab\tand  two\n\nlines \x0b end ",
        "İstanbul Σίσυφος … «quoted» ½ 中文 ﬁ é",
        "12 345 a1b2 !? ... --",
        base + " one more word",
        base.upper(),
        " ".join(base.split()[3:]),
        (base + " ") * 60,
        "a" * 3000,
        "ab" * 40 + " " + "é" * 70,
    ]
    found += [(10_000 + k, text, "en" if k % 2 else None) for k, text in enumerate(odd)]
    found += [(10_010, odd[10], "en"), (None, base, "en"), (None, None, None), (0, found[0][1], "xx")]
    return found


def documents(spark, n: int = 80):
    """The rows with columns whose names clash with those that operators make."""
    filled = [(i, t, lang, "s", len(t or ""), *["x"] * 9) for i, t, lang in rows(n)]
    return spark.createDataFrame(filled, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
