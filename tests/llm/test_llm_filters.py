"""Duplicates, secrets, quality rules and chat windows against plain Python."""

import hashlib
import math
import random
import re
import unicodedata
from collections import Counter, defaultdict

import pytest
from llm_fixtures import documents, empty, lower, rows, words
from pyspark.sql import functions as F

from ticketlens.llm import chat_windows, divergence_rules, exact_dedup, near_dedup, secret_links
from ticketlens.llm.components import components
from ticketlens.llm.scratch import Scratch


def test_exact_groups_of_odd_rows(spark):
    groups = defaultdict(list)
    for doc_id, text, _ in rows():
        groups[lower(text or "")].append(doc_id)
    wanted = []
    for text, ids in groups.items():
        best = max(ids, key=lambda i: (i is not None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        wanted += [(i, best, len(ids), digest) for i in ids]
    docs = documents(spark).repartition(6)
    for heavy in (1, 512):  # few and many of the groups go by the broadcast
        found = exact_dedup.find_exact(docs, tracked=512, heavy=heavy).collect()
        got = [(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found]
        assert sorted(map(repr, got)) == sorted(map(repr, wanted))
        kept = [r for r in found if r["kept"]]
        assert len(kept) == len(groups) == len({r["text_sha256"] for r in kept})
        assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_filter_keeps_rows_and_columns(spark):
    docs = documents(spark)
    kept = exact_dedup.drop_exact(docs)
    assert kept.columns == docs.columns
    texts = [lower(r["text"] or "") for r in kept.collect()]
    assert sorted(texts) == sorted({lower(t or "") for _, t, _ in rows()})
    assert exact_dedup.find_exact(empty(spark)).count() == exact_dedup.drop_exact(empty(spark)).count() == 0


def test_exact_filter_by_broadcast_and_by_shuffle_agree(spark, monkeypatch):
    texts = F.when(F.col("id") % 3 == 0, "Same").when(F.col("id") % 3 == 1, F.concat(F.lit("t"), F.col("id") % 100))
    docs = spark.range(900).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 400).alias("doc_id"),
        texts.otherwise(F.col("id").cast("string")).alias("text"),
        (F.col("id") % 7).alias("other"),
    )
    wanted = {}
    for r in docs.collect():  # the largest doc_id of a text, and of rows that agree in it one
        key = lower(r["text"])
        wanted[key] = max(wanted.get(key, -1), -1 if r["doc_id"] is None else r["doc_id"])
    results = []
    for heavy, bits, parts in ((1, 1 << 26, 3), (512, 1 << 26, 11), (2, 1 << 15, 5)):
        monkeypatch.setattr(exact_dedup, "BITS", bits)
        kept = exact_dedup.drop_exact(docs.repartition(parts), heavy=heavy)
        results.append(sorted(map(repr, kept.collect())))
        got = {lower(r["text"]): -1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()}
        assert got == wanted and len(results[-1]) == len(wanted)
    assert results[0] == results[1] == results[2]


def test_texts_that_occur_once_are_not_shuffled(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.format_string("text %d", F.col("id") % 3990).alias("text"))
    kept = exact_dedup.drop_exact(docs.union(docs.where("doc_id < 10")))
    assert kept.count() == 3990
    plan = kept.queryExecution if hasattr(kept, "queryExecution") else kept._jdf.queryExecution()
    assert "Union" in plan.executedPlan().toString()


def test_hot_copies_are_never_shuffled_whole(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.col("id").cast("string")).alias("text"),
    )
    found = exact_dedup.find_exact(docs).where("group_size > 1")
    assert found.count() == 1334 and found.where("kept").first()["doc_id"] == 3999


def shingle_set(text, width):
    found = words(lower(text or ""))
    if len(found) >= width:
        return {tuple(found[k : k + width]) for k in range(len(found) - width + 1)}
    return {tuple(found)} if found else set()


def brute_components(pairs, width):
    sets = [shingle_set(t, width) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    least = {}
    for n, (doc_id, _) in enumerate(pairs):
        least.setdefault(find(n), []).append(doc_id)
    least = {r: min(ids, key=lambda i: (i is None, i or 0)) for r, ids in least.items()}
    return [(pairs[n][0], len(sets[n]), least[find(n)]) for n in range(len(pairs))]


@pytest.mark.parametrize("width", [2, 5])
def test_near_groups_of_odd_rows(spark, width):
    pairs = [(i, t) for i, t, _ in rows()]
    found = near_dedup.link(documents(spark).repartition(5), width).collect()
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found]
    wanted = brute_components(pairs, width)
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    empties = sum(not n for _, n, _ in wanted)
    groups = len({c for _, n, c in wanted if n})
    assert sum(r["kept"] for r in found) == groups + empties


def test_near_filter_keeps_rows_and_columns(spark):
    docs = documents(spark, 40)
    kept = near_dedup.drop_near(docs)
    assert kept.columns == docs.columns
    assert kept.count() == near_dedup.link(docs).where("kept").count()
    assert near_dedup.link(empty(spark)).count() == near_dedup.drop_near(empty(spark)).count() == 0


def test_large_groups_of_near_copies_stay_linear(spark, monkeypatch):
    """A chain and a cluster larger than a leaf: every link is found, pairs stay near the rows."""
    monkeypatch.setattr(near_dedup, "LEAF", 8)
    monkeypatch.setattr(near_dedup, "DEALT", 16)
    base = [f"w{k}" for k in range(60)]
    made = []
    for n in range(150):
        text = list(base)
        text[n % 60] = f"x{n}"
        made.append((n, " ".join(text)))
    # neighbours of the chain are similar, its ends are not
    made += [(1000 + n, " ".join(f"c{k}" for k in range(3 * n, 3 * n + 60))) for n in range(30)]
    made += [(2000 + n, " ".join(f"d{n}-{k}" for k in range(40))) for n in range(50)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    found = near_dedup.link(docs, 2, levels=3).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found)
    assert got == sorted(brute_components(made, 2))


def star_family(size, base_at, seed=5):
    """Copies with eight of 200 words edited, 0.85 like the base and 0.72 like each other."""
    draw, base, made = random.Random(seed), [f"w{k}" for k in range(200)], []
    for n in range(size):
        text = list(base)
        for k in draw.sample(range(200), 8) if n != base_at else ():
            text[k] = f"x{n}-{k}"
        made.append((n, " ".join(text)))
    return made


@pytest.mark.parametrize("trees", [1, 12])
def test_large_star_around_a_later_row_is_linked_whole(spark, monkeypatch, trees):
    """Members of a node of several dealt leaves that link to the base alone, in whichever leaf it is."""
    monkeypatch.setattr(near_dedup, "LEAF", 8)
    monkeypatch.setattr(near_dedup, "DEALT", 16)
    made = star_family(150, 97)
    docs = spark.createDataFrame(made, "doc_id long, text string")
    found = near_dedup.link(docs, 2, trees=trees, levels=1).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found)
    wanted = sorted(brute_components(made, 2))
    if trees > 1:
        assert got == wanted
    else:  # one tree finds what agrees with the base at its position, and all of that
        classes = [c for _, _, c in got]
        assert max(map(classes.count, classes)) > 100
    assert len({c for _, _, c in wanted}) < 5


def test_two_families_that_are_nearly_alike_stay_apart(spark, monkeypatch):
    """Large groups of copies 0.7 like each other: one node holds both, no link joins them, all members count."""
    monkeypatch.setattr(near_dedup, "LEAF", 8)
    monkeypatch.setattr(near_dedup, "DEALT", 16)
    base, made = [f"w{k}" for k in range(100)], []
    for n in range(120):
        text = list(base)
        if n % 2:
            text[10:20] = [f"v{k}" for k in range(8)]
        text[-1 - n % 3] = f"x{n}"
        made.append((n, " ".join(text)))
    found = near_dedup.link(spark.createDataFrame(made, "doc_id long, text string"), 2).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found)
    assert got == sorted(brute_components(made, 2))


@pytest.mark.parametrize("width", [2, 5])
def test_recall_at_the_threshold(spark, width):
    """600 pairs between 0.80 and 0.84, half of whose words stand in all texts."""
    draw, made = random.Random(11), []
    shared = [f"s{k}" for k in range(60)]
    for n in range(600):
        one = shared + [f"a{n}-{k}" for k in range(140)]
        two = list(one)
        edits = {2: 9, 5: 4}[width]
        for k in draw.sample(range(70, 200, 6), edits):
            two[k] = f"b{n}-{k}"
        made += [(2 * n, " ".join(one)), (2 * n + 1, " ".join(two))]
    links = 0
    for n in range(600):
        one, two = shingle_set(made[2 * n][1], width), shingle_set(made[2 * n + 1][1], width)
        links += 80 <= 100 * len(one & two) / len(one | two) < 84
    assert links > 500
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.link(
        spark.createDataFrame(made, "doc_id long, text string"), width).collect()}
    assert sum(found[2 * n + 1] == 2 * n for n in range(600)) >= 599


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (300, 200)]
    found = components(Scratch(spark, "test"), spark.createDataFrame(edges, "a long, b long"), "c").collect()
    roots = {r["row"]: r["root"] for r in found}
    assert len(roots) == len(found)
    assert {roots[k] for k in range(1, 41)} == {1} and {roots[100 + k] for k in range(30)} == {100}
    assert roots[300] == roots[200] == 200


ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KEY = "AKIA" + "Q7" * 8
MIXED = "aB3" * 13 + "Z"


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for rank, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        found += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [(secret_links.KINDS[k], a, b) for a, k, b in sorted(found)]


SECRETS = [
    "password=token:abcdefgh1 token=secret=abcdefgh",
    "Passwd : 'hunter2' API_KEY=\"x.y-z_1\" apikey=12345 secret==abcde",
    "é🙂 token = \"0cab398dc11d1a2a11dc6572c8df8bd228c864f3\" é",
    "AKIA AKIAabc " + KEY + "XAKIA12 " + KEY[:12],
    "deadbeef " + "0123456789abcdef" * 3 + "g" + "f" * 23,
    "PASSWORD=" + "a" * 50_000,
]


def test_base_spans_of_odd_rows(spark):
    made = [(n, t) for n, t in enumerate(SECRETS)] + [(i, t) for i, t, _ in rows(60)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in made], "doc_id long, text string, spans string, row long")
    got = Counter()
    for r in secret_links.find_secrets(docs).collect():
        spans = tuple((s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in secret_links.BASE)
        got[r["doc_id"], spans] += 1
    assert got == Counter((i, tuple(base_spans(t or ""))) for i, t in made)
    assert secret_links.find_secrets(empty(spark)).count() == 0


def weak_kinds(spark, text, scope=300):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = secret_links.find_secrets(docs, scope).first()["spans"]
    assert all(text[s["start"] : s["end"]] for s in spans)
    return [s["kind"] for s in spans if s["kind"] not in secret_links.BASE]


def test_weak_parts_need_their_complements(spark):
    far = " lorem ipsum" * 40
    url = "https://store.example.com/data"
    assert weak_kinds(spark, f"see {url} and {MIXED[:39]} only") == []
    assert weak_kinds(spark, f"{MIXED} alone") == []
    assert weak_kinds(spark, f"{KEY} then {MIXED}") == ["weak_secret"]
    assert weak_kinds(spark, f"{KEY} {far} {MIXED}") == []
    assert weak_kinds(spark, f"{KEY} {far} {MIXED}", 600) == ["weak_secret"]
    assert weak_kinds(spark, f"{MIXED} at {url}") == ["weak_secret"]
    assert weak_kinds(spark, f"{url} {KEY} {MIXED}") == ["endpoint", "weak_secret"]
    assert weak_kinds(spark, f"client_id: app-1234 {far} password=abcdefg") == []
    assert weak_kinds(spark, "client_id: app-1234, password=abcdefg") == ["weak_id"]
    # a long part lies over many buckets
    assert weak_kinds(spark, f"{'0a' * 2000} ASIA{'Z9' * 6}", 50) == ["weak_id"]


def test_masks_replace_spans_and_nothing_else(spark):
    texts = ["é token=abcdef1234567890abcdef1234567890 end", "clean text", None, "", KEY + " " + MIXED]
    docs = spark.createDataFrame(
        [(n, t, len(t or ""), "k") for n, t in enumerate(texts)] + [(0, texts[0], 44, "k")],
        "doc_id long, text string, n_chars long, spans string",
    )
    masked = secret_links.mask_secrets(docs)
    assert masked.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in masked.collect()), key=repr)
    first = (0, "é <SECRET> end", 14)
    rest = [(1, "clean text", 10), (2, None, 0), (3, "", 0), (4, "<SECRET> <SECRET>", 17)]
    assert found == sorted([first, first, *rest], key=repr)
    assert secret_links.mask_secrets(empty(spark)).count() == 0


def test_counts_of_odd_rows(spark):
    wanted = []
    for doc_id, text, _ in rows():
        text = text or ""
        found = words(text)
        at = defaultdict(list)
        for k in range(len(found) - 7):
            at[tuple(found[k : k + 8])].append(k)
        twice = {p for places in at.values() if len(places) > 1 for k in places for p in range(k, k + 8)}
        lines = [line for line in text.split("\n") if words(line)]
        n = len(found)
        counts = (n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)))
        wanted.append((doc_id, *counts, len(twice), n < 20 or 100 * len(twice) > 30 * n))
    found = divergence_rules.judge(documents(spark)).collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r[c] for c in names)) for r in found)
    assert all(not r["kept"] for r in found if r["base_failed"])
    assert divergence_rules.judge(empty(spark)).count() == 0


def test_divergent_texts_fail_and_short_ones_are_guarded(spark):
    base = [(i, t, lang) for i, t, lang in rows(60)[:60]]
    text = next(t for _, t, lang in base if lang == "en" and 1500 < len(t) < 5000)
    odd = [
        (901, " ".join(f"{w}&&&" for w in words(text)), "en"),
        (902, text.upper(), "en"),
        (903, " ".join(f"q{k}z" for k in range(400)), "en"),
        (904, " ".join(f"q{k}z" for k in range(30)), "en"),
        (905, text, "unlisted"),
    ]
    docs = spark.createDataFrame([*base, *odd], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in divergence_rules.judge(docs).collect()}
    assert [found[i]["kept"] for i in (901, 902, 903, 904, 905)] == [False, False, False, True, True]
    assert found[904]["word_distance"] is None and found[903]["word_distance"] > divergence_rules.MAX_WORD_DISTANCE


ITALIAN = (
    "il sole era appena sorto quando la nave lasciò il porto e i marinai cantavano una vecchia canzone che nessuno "
    "ricordava più mentre il vento portava verso terra profumo di pane e di sale "
).split()


def test_words_of_languages_without_a_list_are_not_judged(spark):
    draw = random.Random(4)
    italian = " ".join(draw.choice(ITALIAN) for _ in range(220))
    base = [(i, t, lang) for i, t, lang in rows(60)[:60]]
    odd = [(901, italian, "it"), (902, italian, None), (903, " ".join(f"q{k}z" for k in range(220)), "en")]
    docs = spark.createDataFrame([*base, *odd], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in divergence_rules.judge(docs).collect()}
    assert found[901]["kept"] and found[902]["kept"] and not found[903]["kept"]
    assert found[901]["word_limit"] is None and found[901]["word_distance"] > divergence_rules.MAX_WORD_DISTANCE


def shannon(p, q):
    """The Jensen-Shannon distance in bits."""

    def half(a, b):
        return sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b, strict=True) if x > 0)

    return math.sqrt(max(0.0, (half(p, q) + half(q, p)) / 2))


def test_distances_and_verdicts_equal_a_plain_version(spark):
    made = [(i, t or "", lang) for i, t, lang in rows()]
    kinds = [re.compile(k) for k in ("[A-Z]", "[0-9]", r"""[.,;:!?'"()-]""", r"[#*$%&|<>]", r"[+/=@\[\\\]^_`{}~\x00-\x08\x0E-\x1F\x7F]")]

    def classes(text):
        n = [len(k.findall(text)) for k in kinds]
        wide = [c for c in text if ord(c) > 127]
        n += [sum(unicodedata.category(c)[0] == "L" for c in wide), sum(unicodedata.category(c)[0] != "L" for c in wide)]
        return [*n, len(text) - sum(n)]

    total, listed = {}, {k: sorted(set(v.split())) for k, v in divergence_rules.COMMON.items()}
    for _, text, lang in made:
        if lang in listed:
            held = total.setdefault(lang, ([0] * 8, Counter(), [0]))
            held[0][:] = [a + b for a, b in zip(held[0], classes(text), strict=True)]
            held[1].update(words(text))
            held[2][0] += len(words(text))

    def shares(counts, n, lang):
        own = [counts[w] / max(1, n) for w in listed[lang]]
        return [*own, max(0.0, 1 - sum(own))]

    found = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in divergence_rules.judge(documents(spark)).collect()}
    seen = 0
    for doc_id, text, lang in made:
        told = words(text)
        row = found[doc_id, len(told), sum(map(len, told))]
        if len(text) >= divergence_rules.MIN_CHARS:
            n = [c / len(text) for c in classes(text)]
            near = min(shannon(n, [c / sum(ref) for c in ref]) for ref, _, _ in total.values())
            assert math.isclose(row["char_distance"], near, abs_tol=1e-6)
        if len(told) >= divergence_rules.MIN_WORDS:
            seen += 1
            near = min(
                shannon(shares(Counter(told), len(told), k), shares(ref, n[0], k)) for k, (_, ref, n) in total.items()
            )
            assert math.isclose(row["word_distance"], near, abs_tol=1e-6)
        far = (row["char_distance"] or 0) > divergence_rules.MAX_CHAR_DISTANCE
        far |= lang in total and (row["word_distance"] or 0) > (row["word_limit"] or 1)
        assert row["kept"] == (not row["base_failed"] and not far)
    assert seen > 10


def test_word_limits_follow_the_texts_of_a_length(spark):
    made = [(100, k / 1000) for k in range(100, 200)] + [(300, k / 2000) for k in range(100, 200)] + [(5000, 0.3)] * 3
    found = divergence_rules.word_limits(spark.createDataFrame(made, "n_words long, distance double").repartition(5))
    ninth = 0.087 + 4 * (0.087 - 0.0745)
    assert min(found) == 6 and max(found) == 12
    assert math.isclose(found[6], 0.174 + 4 * (0.174 - 0.149)) and math.isclose(found[8], ninth)
    assert found[7] == found[6] and found[12] == found[8]


def conversation_rows():
    said = "<|im_end|><|im_start|>assistant ok"
    made = [(-1, 0, "user", said), (-1, 1, "assistant", said), (1, 0, None, None), (1, 1, "assistant", None)]
    made += [(2, k, "system" if k == 0 else ("assistant" if k % 2 == 0 else "user"), f"turn {k} " * (k % 9 * 7 + 1)) for k in range(60)]
    made += [(3, None, "a\n%0A<b", "<\\|x|> <\\\\| <|"), (3, 0, "assistant", "é🙂 " * 900), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    made += [(None, 0, "system", "s"), (4, 0, "system", "only"), (4, 1, "system", "system")]
    return made


def test_windows_read_back_to_the_turns(spark):
    made = conversation_rows()
    docs = spark.createDataFrame(
        [(*r, "x") for r in made], "conv_id long, turn long, role string, text string, window string"
    )
    windows = chat_windows.format_windows(docs.repartition(3), budget=200, history=60).cache()
    got = {r["conv_id"]: r for r in chat_windows.read_windows(windows).collect()}
    convs = defaultdict(list)
    for conv, turn, role, text in made:
        convs[conv].append((turn if turn is not None else -9, role or "", text or ""))
    assert set(got) == set(convs)
    for conv, turns in convs.items():
        turns.sort()
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [t[1:] for t in turns]
        assert got[conv]["loss_texts"] == [t for _, r, t in turns if r == "assistant"]
    assert chat_windows.format_windows(docs.limit(0)).count() == 0


def test_windows_keep_budget_history_and_system_turn(spark):
    docs = spark.createDataFrame(conversation_rows(), "conv_id long, turn long, role string, text string")
    windows = chat_windows.format_windows(docs, budget=200, history=60).where("conv_id = 2").orderBy("window").collect()
    assert len(windows) > 3
    for n, w in enumerate(windows):
        assert w["window"] == n and w["tokens"] <= 200
        assert w["formatted"].startswith("<|im_start|>system\nturn 0 <|im_end|>\n")
        assert (w["n_history"] > 0) == (n > 0) or n > 0
        for s in w["loss"]:
            assert w["formatted"][: s["start"]].endswith("<|im_start|>assistant\n")
            assert w["formatted"][s["end"] :].startswith("<|im_end|>\n")
    assert any(w["n_history"] for w in windows)


def test_large_system_turns_are_shown_once_and_no_window_exceeds_the_budget(spark):
    made = [(1, 0, "system", "rule " * 600)] + [(1, k, "user" if k % 2 else "assistant", "w " * 20) for k in range(1, 21)]
    made += [(2, 0, "system", "rule " * 60)] + [(2, k, "user" if k % 2 else "assistant", "w " * 90) for k in range(1, 21)]
    made += [(3, k, "system", "rule " * 100) for k in range(5)] + [(4, 0, "user", "w " * 900), (4, 1, "assistant", "w")]
    docs = spark.createDataFrame(made, "conv_id long, turn long, role string, text string")
    windows = chat_windows.format_windows(docs).orderBy("conv_id", "window").collect()
    for w in windows:
        alone = w["n_new"] == 1 and w["n_history"] == 0
        assert w["tokens"] <= chat_windows.BUDGET or alone
    of = {conv: [w for w in windows if w["conv_id"] == conv] for conv in range(1, 5)}
    assert {w["n_system"] for w in of[1]} == {0} and sum("rule" in w["formatted"] for w in of[1]) == 1
    assert sum(w["tokens"] for w in of[1]) < 2 * (604 + 20 * 24)
    assert {w["n_system"] for w in of[2]} == {1} and all("rule" in w["formatted"] for w in of[2])
    assert {w["n_system"] for w in of[3]} == {0}
    read = {r["conv_id"]: r for r in chat_windows.read_windows(chat_windows.format_windows(docs)).collect()}
    for conv in range(1, 5):
        wanted = [(r, t) for c, _, r, t in made if c == conv]
        assert [(t["role"], t["text"]) for t in read[conv]["turns"]] == wanted
        assert read[conv]["loss_texts"] == [t for r, t in wanted if r == "assistant"]


def plain_windows(turns, budget, history):
    """(window, turns shown, of them repeated) of one conversation's (role, text, tokens), one after the other."""
    span = chat_windows.SLICE * budget
    before = [sum(t[2] for t in turns[:k]) for k in range(len(turns) + 1)]
    lead = next((k for k, t in enumerate(turns) if t[0] != "system"), len(turns))
    lead = lead if before[lead] <= (budget - history) // 2 else 0
    room = budget - history - before[lead]
    found, first = [], lead
    for k in range(lead, len(turns) + 1):
        ends = k == len(turns) or (
            k > first and (before[k + 1] - before[first] > room or before[k] // span != before[first] // span)
        )
        if ends:
            fits = before[k] - before[first] <= room
            back = first
            while fits and back > lead and before[back - 1] >= before[first] - history:
                back -= 1
            number = 0 if not found else before[first] // span * span
            while any(f[0] == number for f in found):
                number += 1
            found.append((number, turns[:lead] + turns[back:k], (lead if found else 0) + first - back))
            first = k
    return found


def test_a_conversation_of_a_third_of_all_rows_is_formatted_in_slices(spark):
    rng = random.Random(5)
    made = []
    for k in range(1500):
        role = "system" if k < 2 else rng.choice(["user", "assistant", "system"])
        made.append((7, k if k > 1 else k - 5, role, "w " * rng.randint(0, 6) + f"<|{k}"))
    made[700] = (7, 700, "assistant", "w " * 9000)  # larger than two slices
    made += [(None, None, "assistant", "same")] * 1500 + [(None, None, "user", "s" * 70 + str(k)) for k in range(9)]
    made += [(100 + k // 3, k % 3, "user", f"x {k}") for k in range(1500)]
    budget, history = 24, 8
    docs = spark.createDataFrame(made, "conv_id long, turn long, role string, text string")
    convs = defaultdict(list)
    for conv, turn, role, text in made:
        convs[conv].append((-9 if turn is None else turn, role, text))
    counts = {}
    for parts in (2, 13):
        windows = chat_windows.format_windows(docs.repartition(parts), budget=budget, history=history)
        got = defaultdict(list)
        for w in windows.orderBy("conv_id", "window").collect():
            got[w["conv_id"]].append((w["window"], w["formatted"], w["n_history"] + (w["window"] > 0) * w["n_system"]))
        assert set(got) == set(convs)
        for conv, turns in convs.items():
            turns = [(r, t, 4 + len(re.findall(r"[^\W_]+|[^\sa-z0-9]", t))) for _, r, t in sorted(turns)]
            wanted = [
                (n, "".join(f"<|im_start|>{r}\n{t.replace('<|', '<' + chr(92) + '|')}<|im_end|>\n" for r, t, _ in shown), old)
                for n, shown, old in plain_windows(turns, budget, history)
            ]
            assert got[conv] == wanted
            counts[conv] = len(wanted)
    assert counts[7] > 300 and max(n for n, _, _ in got[7]) > 2 * chat_windows.SLICE * budget
    each = chat_windows.read_each(windows).where("conv_id = 7")
    assert each.agg(F.sum(F.size("turns"))).first()[0] == 1500
    assert each.agg(F.max(F.size("turns"))).first()[0] < 20


def test_no_step_before_the_slices_gathers_turns(spark):
    docs = spark.createDataFrame(conversation_rows(), "conv_id long, turn long, role string, text string")
    plan = chat_windows.format_windows(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1 and "slice#" in plan
