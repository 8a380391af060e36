"""Importance resampling, suffix-array dedup and fill-in-the-middle against plain versions of their definitions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import fill_in_middle, importance, suffix_dedup
from ledgerloom.llm import queries as registered

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


# Importance resampling


def plain_features(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain_resample(docs, target, percent=25, least=20):
    """Sorted (doc_id, n_features, weight, score, rank)."""
    featured = [(i, *plain_features(t)) for i, t in docs]
    have = collections.Counter(f for _, _, fs in featured for f in fs)
    want = collections.Counter(f for t in target for f in plain_features(t)[1])
    all_have, all_want = sum(have.values()), sum(want.values())
    gain = [math.floor(1000 * math.log((want[b] + 1) * (all_have + 10_000) / ((have[b] + 1) * (all_want + 10_000)))) for b in range(10_000)]
    rows = []
    for i, n, fs in featured:
        weight = sum(gain[f] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((n, i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0))
    drawn = fit[: percent * len(fit) // 100]
    ranks = collections.defaultdict(list)
    for k, r in enumerate(drawn):
        ranks[r].append(k + 1)
    out = [(*r[1:], ranks[r].pop(0) if ranks[r] else None) for r in rows]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_resampling_on_the_tables(spark, small, documents):
    bench = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = found(registered.op11_importance_resampling(spark, small))
    assert got == plain_resample(docs, bench)
    assert any(r[4] for r in got)


def test_resampling_of_odd_rows(spark, odd, odd_rows, empty):
    target = spark.createDataFrame([("alpha beta gamma",), (None,), ("",), ("x" * 300 + " " + "y" * 200,)], "text string")
    wanted = [r["text"] for r in target.collect()]
    assert found(importance.resample(odd, target, percent=60)) == plain_resample(odd_rows, wanted, 60)
    assert found(importance.resample(empty, target)) == []
    # Without a target every gain follows from zero counts.
    assert found(importance.resample(odd, empty)) == plain_resample(odd_rows, [])


def test_one_row_many_times_is_ranked_row_by_row(spark):
    text = " ".join(f"w{i}" for i in range(30))
    many = spark.createDataFrame([(7, text)] * 400 + [(i, text + f" {i}") for i in range(100)], "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(text,)], "text string")
    rows = importance.resample(many, target, percent=50).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 251))
    drawn = sorted((r["rank"], -r["score"]) for r in rows if r["rank"])
    assert [s for _, s in drawn] == sorted(s for _, s in drawn)


@pytest.mark.parametrize("seed", range(4))
def test_buckets_of_word_runs(seed):
    rng = random.Random(seed)
    alphabet = "abcXYZ019é漢\U0001f511_-. \t\n{`@[/:\x00\x7f"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 40, 400]))) for _ in range(60)]
    texts += ["", "word", "q" * 64, "q" * 65, f"a {'r' * 70} b {'s' * 200}", "end", ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    out, starts = importance.word_crcs(data, offsets, 10_000)
    assert [out[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [plain_features(t)[1] for t in texts]


# Suffix-array dedup


def plain_removal(texts, window):
    """(n_bytes, runs removed, kept) of each text."""
    data = [(t or "").encode() if not isinstance(t, bytes) else t for t in texts]
    seen = collections.Counter(b[i : i + window] for b in data for i in range(len(b) - window + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        out.append((len(b), [tuple(x) for x in edges.reshape(-1, 2).tolist()], bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def removed(df):
    return sorted(((r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in df.select("n_bytes", "spans", "kept").collect()), key=repr)


def test_removal_on_the_table(spark, small, documents):
    docs = documents.select("doc_id", "text").collect()
    plain = {r["doc_id"]: x for r, x in zip(docs, plain_removal([r["text"] for r in docs], 400))}
    rows = registered.op12_suffix_dedup(spark, small).collect()
    assert len(rows) == len(docs) and any(r["n_removed"] for r in rows)
    for r in rows:
        n, runs, kept = plain[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, n - len(kept), len(runs), hashlib.sha256(kept).hexdigest())


def passages(rng, kind):
    """Texts that share passages of about a window's length, or are periodic, or are loose copies."""
    letters = "ab" if kind == "two letters" else "abcdefgh"
    noise = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [noise(n) for n in (18, 20, 21, 25, 60)]
    texts = [noise(rng.randrange(30)) + rng.choice(shared) + noise(rng.randrange(30)) for _ in range(60)]
    if kind == "periodic":
        texts += ["x" * 45, "x" * 20, "x" * 19, "xy" * 30, "abc" * 25, "abc" * 7, noise(10) + "z" * 24]
    if kind == "copies":
        base = noise(150)
        for _ in range(60):
            letters_of = list(base)
            for _ in range(4):
                letters_of[rng.randrange(len(base))] = rng.choice(letters)
            texts.append("".join(letters_of))
        texts += [base] * 5
    return texts + [None, "", "a", texts[0]]


@pytest.mark.parametrize("kind", ["two letters", "periodic", "copies"])
@pytest.mark.parametrize("sizes", [{}, {"shard": 4, "slice_rows": 8}, {"shard": 1, "slice_rows": 1, "parts": 3}])
def test_removal_of_short_windows(spark, kind, sizes):
    texts = passages(random.Random(f"{kind}{sizes}"), kind)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    rows = {r["others"]["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, 20, gram=6, **sizes).collect()}
    got = [(rows[i]["n_bytes"], [tuple(s) for s in rows[i]["spans"]], bytes(rows[i]["kept"])) for i in range(len(texts))]
    assert got == plain_removal(texts, 20)


def test_removal_of_odd_rows(spark, odd, odd_rows, empty):
    got = suffix_dedup.remove_repeats(odd, 40, gram=10)
    assert removed(got) == sorted(plain_removal([t for _, t in odd_rows], 40), key=repr)
    assert got.select("others.*").columns == [c for c in odd.columns if c != "text"]
    assert suffix_dedup.remove_repeats(empty).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_suffix_arrays_and_common_prefixes(seed):
    rng = random.Random(seed)
    parts = [bytes(rng.choice(b"ab\x00" if seed % 2 else b"a") for _ in range(rng.randrange(1, 40))) for _ in range(25)]
    sizes = [len(p) for p in parts]
    data, ends = np.frombuffer(b"".join(parts), np.uint8), np.repeat(np.cumsum(sizes), sizes)
    suffixes = sorted((tuple(x + 1 + len(parts) for x in p[i:]) + (n,), sum(sizes[:n]) + i) for n, p in enumerate(parts) for i in range(len(p)))
    order = suffix_dedup.suffix_array(data, ends)
    assert order.tolist() == [at for _, at in suffixes]

    def common(a, b):
        return next(k for k, (x, y) in enumerate(zip(a, b)) if x != y)

    assert suffix_dedup.common_prefixes(data, ends, order).tolist() == [0] + [common(a, b) for (a, _), (b, _) in zip(suffixes, suffixes[1:])]


def test_anchors_do_not_depend_on_how_texts_are_cut(monkeypatch):
    """Each window of each text has one anchor, the same in whatever pieces the texts are read."""
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 101, n, dtype=np.uint8)) for n in (0, 5, 19, 20, 700, 3000, 40, 41, 0, 2500)] + [b"z" * 90]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])

    def anchor_of_windows():
        found = [x for columns in suffix_dedup.Anchors(20, 6).of_texts(data, offsets) for x in zip(*(c.tolist() for c in columns))]
        return sorted((text, window, place, value) for text, place, first, last, value in found for window in range(first, last + 1))

    whole = anchor_of_windows()
    assert [x[:2] for x in whole] == [(n, i) for n, t in enumerate(texts) for i in range(len(t) - 19)]
    assert all(i <= place <= i + 14 for _, i, place, _ in whole)
    assert len({(texts[n][p : p + 6], v) for n, _, p, v in whole}) == len({v for *_, v in whole})
    for size in (64, 100, 999):
        monkeypatch.setattr(suffix_dedup, "CHUNK", size)
        assert anchor_of_windows() == whole


# Fill in the middle


def plain_middle(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return len(text), "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def middles(df):
    return sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in df.collect()), key=repr)


def test_middles_of_odd_rows(spark, odd, odd_rows, empty):
    extra = [(i, t) for i, t in enumerate(["<P>", "a<S>b", "<M", "<P >", "<<P", "漢字\U0001f511é\x00x" * 9, "S>", "<", "\n", "<Q>"] * 9, 100)]
    docs = spark.createDataFrame(extra, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    made = fill_in_middle.fill_in_middle(docs)
    assert middles(made) == sorted(((i, *plain_middle(i, t)) for i, t in extra + odd_rows), key=repr)
    texts = made.select(fill_in_middle.restored().alias("t")).collect()
    assert sorted(r["t"] for r in texts) == sorted(t or "" for _, t in extra + odd_rows)
    assert fill_in_middle.fill_in_middle(empty).collect() == []


def test_middles_on_the_table(spark, small, documents):
    rows = {r["doc_id"]: r for r in registered.op13_fill_in_middle(spark, small).collect()}
    for doc in documents.select("doc_id", "text").collect():
        r, (n, form, a, m, output) = rows[doc["doc_id"]], plain_middle(doc["doc_id"], doc["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, a, m)
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((doc["text"] or "").encode()).hexdigest()


def test_ranked_bits():
    rng = random.Random(3)
    for size in (1, 2, 7, 64, 1000):
        bits = rng.getrandbits(size)
        places = [i for i in range(size) if bits >> i & 1]
        assert [fill_in_middle.select(bits, k, size) for k in range(len(places) + 2)] == [*places, size, size]
    with pytest.raises(ValueError):
        importance.feature_streams(None, 70_000, "doc_id", "text")


def test_large_texts_leave_in_parts(spark):
    docs = spark.range(12).select(F.col("id").alias("doc_id"), F.expr("repeat('abcdé<', 400000)").alias("text"))
    made = fill_in_middle.fill_in_middle(docs).select("n", F.sha2(fill_in_middle.restored().cast("binary"), 256).alias("h")).collect()
    assert {r["n"] for r in made} == {2_400_000} and len({r["h"] for r in made}) == 1
