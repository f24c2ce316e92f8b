"""Substring dedup, fill-in-middle and conversation repair against plain Python."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from llm_fixtures import documents, empty, rows, words
from pyspark.sql import functions as F

from ticketlens.llm import conversation_repair, fill_middle, substring_dedup

TOKEN = re.compile(fill_middle.TOKEN)


def without_repeats(texts, width):
    """Kept words and number of removed ones per (doc_id, text), in the operator's order."""
    seen, out = set(), []
    for doc_id, text in texts:
        found, gone = words(text), set()
        for s in range(len(found) - width + 1):
            window = tuple(found[s : s + width])
            if window in seen:
                gone.update(range(s, s + width))
            seen.add(window)
        out.append((doc_id, len(found), len(gone), " ".join(w for k, w in enumerate(found) if k not in gone)))
    return out


@pytest.mark.parametrize(("width", "bucket_bytes"), [(20, 24 << 20), (4, 4096), (1, 24 << 20)])
def test_repeated_windows_go(spark, width, bucket_bytes):
    # equal ids are ordered by a hash of the text, so the brute force takes each id once
    texts = {i: t for i, t, _ in rows() if i is not None}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, chunk string")
    found = substring_dedup.remove_repeats(docs.repartition(5), width, bucket_bytes).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found)
    assert got == without_repeats(sorted(texts.items()), width)
    for r in found:
        spans = [(one["from"], one["until"]) for one in r["removed"]]
        assert sum(b - a for a, b in spans) == r["n_removed"]
        assert all(b < a for (_, b), (a, _) in zip(spans, spans[1:], strict=False))


def test_repeats_of_rows_without_an_id_and_of_equal_ids(spark):
    found = substring_dedup.remove_repeats(documents(spark), 5).collect()
    assert len(found) == len(rows())
    long = "one two three four five six"
    docs = spark.createDataFrame(
        [(3, long), (3, long), (None, long), (None, None), (9, "x " + long), (10, "")], "doc_id long, text string"
    )
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in substring_dedup.remove_repeats(docs, 5).collect())
    assert got == [(0, 0), (0, 0), (3, 6), (3, 6), (9, 6), (10, 0)]
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("substrings_")]


def test_a_passage_that_a_third_of_the_documents_share(spark):
    passage = " ".join(f"w{k}" for k in range(25))
    said = F.when(F.col("id") % 3 == 0, F.concat(F.lit(passage + " "), F.col("id"))).otherwise(F.col("id").cast("string"))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), said.alias("text")).repartition(20)
    found = substring_dedup.remove_repeats(docs, 20)
    assert found.where("n_removed = 25").count() == 999
    assert found.where("doc_id = 0").first()["n_removed"] == 0


@pytest.mark.parametrize("n_bytes", [0, 1 << 20, 1 << 40, 1 << 50])
def test_packed_hashes_come_back(n_bytes):
    import numpy as np

    layout = substring_dedup.Layout(n_bytes, 24 << 20)
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64 - 1, 5000, np.uint64))
    buckets, at = layout.split(keys)
    for bucket, begin, end in zip(buckets[:50], at[:-1], at[1:], strict=False):
        lows, gaps, low = substring_dedup._pack(keys[begin:end], layout.bits)
        back = substring_dedup._unpack(lows, gaps, low, end - begin)
        lead = np.uint64(bucket << (64 - layout.bits)) if layout.bits else np.uint64(0)
        assert (back | lead == keys[begin:end]).all()


def test_a_second_hash_tells_windows_apart_on_large_data(spark, monkeypatch):
    """With the bytes of a large corpus the second hash travels too, with the same result."""
    docs = documents(spark)
    plain = sorted(map(repr, substring_dedup.remove_repeats(docs, 6).collect()))
    real = substring_dedup.Layout
    monkeypatch.setattr(substring_dedup, "Layout", lambda n, b: real(1 << 42, 1 << 42))
    assert real(1 << 42, 1 << 42).extra > 0
    assert sorted(map(repr, substring_dedup.remove_repeats(docs, 6).collect())) == plain


def middle_out(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle_of_odd_rows(spark):
    odd = [(50_000 + k, t, None) for k in range(12) for t in ("<P> x <S", "a <S><P> b", "$1 \\ <M", "< P> <", "\n\n", "<S")]
    table = [*rows(), *odd]
    docs = spark.createDataFrame([(i, t, 1, "f") for i, t, _ in table], "doc_id long, text string, n int, form string")
    made = fill_middle.transform(docs)
    found = made.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    got = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in found]
    assert sorted(map(repr, got)) == sorted(repr(middle_out(i, t)) for i, t, _ in table)
    assert sorted(r["back"] for r in found) == sorted(t or "" for _, t, _ in table)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    assert fill_middle.transform(empty(spark)).count() == 0


def test_fill_in_middle_of_a_very_long_text_takes_no_stack(spark):
    docs = spark.range(8).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab \U0001f600\n"), 300_000).alias("text"))
    made = fill_middle.transform(docs)
    back = made.select((fill_middle.restore(F.col("output"), F.col("form")) == F.repeat(F.lit("ab \U0001f600\n"), 300_000)).alias("ok"))
    assert [r["ok"] for r in back.collect()] == [True] * 8
    assert made.where("form <> 'plain' AND n = 600001").count() > 0


def least_repair(turns):
    """Cheapest edits by Dijkstra's algorithm over (cost, audit), from (role, text) rows."""
    seen, faults = set(), []
    for role, text in turns:
        end = text.rstrip(" \t\n\x0b\f\r")[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "cut" if end not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, at, last, said = heapq.heappop(heap)
        if at == len(turns) and last in ("", "a"):
            return cost, audit, said, faults
        if done.get((at, last), (cost, audit)) < (cost, audit):
            continue
        done[at, last] = (cost, audit)
        wanted, name = ("a", "assistant") if last == "u" else ("u", "user")
        heapq.heappush(heap, (cost + 2, audit + "I", at, wanted, (*said, f"{name}:")))
        if at < len(turns):
            role, text = turns[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, said))
            if faults[at] not in ("blank", "duplicate"):
                more = faults[at] == "cut"
                if role[:1] == wanted or (role[:1] == "s" and not last):
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[:1], (*said, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, wanted, (*said, f"{name}:{text}")))


def _random_turns(n, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "superuser", None]
    texts = ["Yes.", "No!", "cut", " \t\n", "", None, "Why?  ", "a b c. ", "é."]
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_repairs_are_the_cheapest_and_first(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "BLOCK", 4)
    told = {c: _random_turns(c % 9 + 1, c) for c in range(120)}
    told[500] = _random_turns(60, 5)
    table = [(c, k, role, text, "x") for c, turns in told.items() for k, (role, text) in enumerate(turns)]
    rows_ = spark.createDataFrame(table, "conv_id long, turn long, role string, text string, block string")
    report, edits = conversation_repair.repair(rows_.repartition(7))
    digests = {r["conv_id"]: r["repaired_sha256"] for r in conversation_repair.digest(edits).collect()}
    found = {r["conv_id"]: r for r in report.collect()}
    assert found.keys() == told.keys()
    legal = {"su", "ua", "au"}
    for c, turns in told.items():
        plain = [(" " if r is None else r, " " if t is None else t) for r, t in turns]
        cost, audit, said, faults = least_repair(plain)
        r = found[c]
        assert (r["cost"], r["audit"], r["gaps"]) == (cost, audit, 0)
        assert [r["blank"], r["duplicate"], r["truncated"]] == [faults.count(f) for f in ("blank", "duplicate", "cut")]
        assert r["illegal"] == sum(a[0][:1] + b[0][:1] not in legal for a, b in zip(plain, plain[1:], strict=False))
        wanted = hashlib.sha256("\n".join(said).encode()).hexdigest() if said else None
        assert digests.get(c) == wanted


def test_repair_of_rows_without_ids_and_of_equal_turns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string, pos string")
    report, edits = conversation_repair.repair(none)
    assert report.count() == edits.count() == conversation_repair.digest(edits).count() == 0
    table = [(None, None, "user", "Hi.")] * 3 + [(None, 2, "assistant", "Yes.")] + [(7, 9, None, None), (7, 2**62, "user", "a.")]
    docs = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    report, edits = conversation_repair.repair(docs)
    found = {r["conv_id"]: (r["duplicate"], r["blank"], r["audit"], r["gaps"]) for r in report.collect()}
    assert found == {None: (2, 0, "KDDK", 0), 7: (0, 1, "DKI", 2**62 - 10)}
    assert edits.where("conv_id = 7 AND edit = 'I' AND role = 'assistant' AND text = ''").count() == 1


def test_a_conversation_of_a_third_of_all_rows_is_dealt_out(spark):
    turns = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -5).otherwise(F.col("id")).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.col("id"), F.lit(".")).alias("text"),
    )
    marked = conversation_repair.mark(turns)
    assert marked.where("conv_id = -5").select("block").distinct().count() > 2
    report, edits = conversation_repair.repair(turns)
    hot = report.where("conv_id = -5").first()
    assert hot["cost"] == 0 and hot["audit"] == "K" * 10_000 and hot["gaps"] == 29_998 - 10_000
    assert edits.where("conv_id = -5").count() == 10_000


def test_damage_by_checksum(spark):
    table = [(c, t, "assistant", "A. B! C?") for c in range(30) for t in range(10)]
    table += [(None, 1, None, None), (3, None, "user", None)]
    found = conversation_repair.damage(
        spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    ).collect()
    wanted = []
    for conv_id, turn, role, text in table:
        said = [" " if v is None else v for v in (conv_id, turn, role, text)]
        slot = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20
        if slot:
            text = "" if slot == 1 else said[3].translate(str.maketrans("", "", ".!?")) if slot == 2 else said[3]
            wanted += [(conv_id, turn, "user" if slot == 4 else said[2], text)] * (2 if slot == 3 else 1)
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))
