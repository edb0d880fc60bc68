"""Source divergence, importance resampling and MinHash near-duplicates against plain models."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import importance_resampling, minhash_dedup, source_divergence
from tollgate.llm.common import pieces, ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["n", "m", "p", "q", "node", "cell", "rank", "score", "weight", "name", "term", "value", "item", "part", "slot", "label", "_n"]
SYLLABLES = "an er the ti on re st ou le mi ka zo É ß 日".split()


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows_of(seed=3, n=160):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 2))) for _ in range(40)]
    rows = []
    for i in range(n):
        favourite = vocabulary[i % 5 : 30 + i % 5]
        text = " ".join(rng.choice(favourite) + rng.choice(["", ",", ".", "-x", "9"]) for _ in range(rng.randint(1, 60)))
        rows.append((i, text, rng.choice(["en", "de"]), f"src{min(i % 7, 3)}"))
    rows += [(900, None, None, None), (901, "", "en", None), (902, " \t\n ", None, "src0"), (903, "One", "de", ""), (904, "?!", "xx", "only")]
    rows += [(905, rows[3][1], "en", "src0"), (905, rows[3][1], "en", "src0"), (3, rows[4][1], "en", "src9"), (None, rows[5][1] * 3, "en", "src2")]
    rows += [(906, "".join(rng.choices("aB9 ,\n", k=300_000)), "en", "src1"), (907, "z" * 250_000, "en", "src2")]
    return [(*row, 0) for row in rows]


@pytest.fixture(scope="module")
def rows():
    return rows_of()


@pytest.fixture(scope="module")
def docs(spark, rows):
    ship(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(5).select("*", *[F.lit(-1).alias(name) for name in CLASHING])


# 11: source divergence


def plain_audit(rows, min_docs, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    holders, counts, groups = collections.Counter(), collections.Counter(), set()
    for _, text, lang, source, _ in rows:
        found = term.findall(lowered(text))
        groups.add((lang or "", source or ""))
        holders.update((lang or "", t) for t in set(found))
        counts.update((lang or "", source or "", t) for t in found)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (of, t), n in holders.items() if of == lang and n >= min_docs]
        sources = [s for of, s in groups if of == lang]
        total = {s: sum(counts[lang, s, t] for t in kept) for s in sources}
        share = {(s, t): 1 + 10**9 * (counts[lang, s, t] + 2) // (total[s] + 2 * len(kept)) for s in sources for t in kept}
        of_lang = {t: 1 + 10**9 * (sum(counts[lang, s, t] for s in sources) + 2) // (sum(total.values()) + 2 * len(kept)) for t in kept}
        for s in sources:
            pair = [(-sum((share[s, t] - share[o, t]) ** 2 // (share[s, t] + share[o, t]) for t in kept), o) for o in sources if o != s]
            best = [(-((share[s, t] - of_lang[t]) ** 2 // (share[s, t] + of_lang[t])), t) for t in kept if counts[lang, s, t] and share[s, t] > of_lang[t]]
            for part, ranked, most in (("pair", pair, None), ("term", best, top)):
                ranked = sorted(ranked, key=lambda x: (x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, -value, i + 1) for i, (value, item) in enumerate(ranked)]
    return out


@pytest.mark.parametrize("min_docs, top", [(10, 10), (3, 4), (10_000, 10)])
def test_audit_equals_plain_counts(docs, rows, min_docs, top):
    got = [tuple(r) for r in source_divergence.audit(docs, min_docs, top).collect()]
    assert sorted(got) == sorted(plain_audit(rows, min_docs, top))


def test_audit_merges_equal_values(spark):
    """Many terms with equal counts share ranks' values and come in UTF-8 order."""
    names = ["z", "ä", "a", "日", "b", "é"] + [f"t{c}" for c in "abcdefghij"]
    rows = [(i, " ".join(names), "en", "x", 0) for i in range(10)] + [(i, "other", "en", "y", 0) for i in range(10, 30)]
    got = source_divergence.audit(spark.createDataFrame(rows, SCHEMA)).where("part = 'term' AND source = 'x'").orderBy("rank").collect()
    assert [r["item"] for r in got] == sorted(names, key=str.encode)[:10] and len({r["value"] for r in got}) == 1
    assert [r["rank"] for r in got] == list(range(1, 11))


def test_audit_of_large_counts_is_exact(spark):
    """Products of counts pass 64 bits and divisions round down."""
    counts = [("en", "a", "x", 4 * 10**12 + 7, 10), ("en", "a", "y", 3, 10), ("en", "b", "x", 5, 10), ("en", "b", "z", 10**12, 10)]
    kept = spark.createDataFrame(counts, "lang string, source string, term string, n long, docs long")
    lang = kept.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    kept = kept.drop("docs").join(lang, ["lang", "term"])
    docs = spark.createDataFrame([("en", "a"), ("en", "b")], "lang string, source string")
    got = source_divergence.pair_divergences(kept, source_divergence._groups(docs, kept)).collect()
    n = {(s, t): c for _, s, t, c, _ in counts}
    p = {s: {t: 1 + 10**9 * (n.get((s, t), 0) + 2) // (sum(v for (o, _), v in n.items() if o == s) + 6) for t in "xyz"} for s in "ab"}
    want = sum((p["a"][t] - p["b"][t]) ** 2 // (p["a"][t] + p["b"][t]) for t in "xyz")
    assert {(r["source"], r["value"]) for r in got} == {("a", want), ("b", want)}


def test_audit_of_nothing(docs):
    assert source_divergence.audit(docs.limit(0)).collect() == []


# 12: importance resampling


def plain_features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) for r in runs]


def test_runs_of_any_length_from_prefixes():
    words = [b"a", "日本".encode(), b"x" * 3000, b"", b"end"]
    prefixes = importance_resampling.Prefixes(words)
    for n in range(1, 7):
        want = [zlib.crc32(b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]
        assert prefixes.runs(n).tolist() == want


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_long_texts_come_in_pieces(longest, monkeypatch):
    monkeypatch.setattr(importance_resampling, "pieces", lambda data: pieces(data, 7))
    text = "The quick, brown fox; jumps over a lazy dog and " + "x" * 40 + " 日本 7up"
    got = np.concatenate(list(importance_resampling.buckets_of(text, longest, 1 << 30)))
    assert sorted(got.tolist()) == sorted(c % (1 << 30) for c in plain_features(text, longest)[1])


@pytest.mark.parametrize("longest, least, percent", [(1, 20, 10), (2, 5, 40)])
def test_resample_equals_plain(spark, docs, rows, longest, least, percent):
    wanted = [(1, rows[7][1]), (2, None), (3, "Once more, with feeling")]
    target = spark.createDataFrame(wanted, "item_id long, text string")
    got = importance_resampling.resample(docs, target, longest, 100, percent, least).collect()
    found = [(r[0], *plain_features(r[1], longest)) for r in rows]
    s = collections.Counter(c % 100 for _, _, f in found for c in f)
    t = collections.Counter(c % 100 for _, text in wanted for c in plain_features(text, longest)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 100) / ((s[b] + 1) * (t.total() + 100)))) for b in range(100)]
    want = []
    for doc, n, f in found:
        weight = sum(gain[c % 100] for c in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        want.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n >= least))
    drawn = sorted((r for r in want if r[4]), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1], r[2]))
    drawn = drawn[: percent * len(drawn) // 100]
    want = collections.Counter(r[:4] + (None,) for r in want) - collections.Counter(r[:4] + (None,) for r in drawn)
    want += collections.Counter(r[:4] + (i + 1,) for i, r in enumerate(drawn))
    assert collections.Counter(tuple(r) for r in got) == want


def test_resample_breaks_ties_by_id(spark):
    scores = [(i, 30, 9, 1, 5 if i % 3 else 7) for i in range(40)] + [(99, 3, 9, 1, 9)]
    rows = spark.createDataFrame(scores, "doc_id long, n_words long, n_features long, weight long, score long")
    got = {r["doc_id"]: r["rank"] for r in importance_resampling._ranked(rows, F.col("n_words") >= 20, 50).collect()}
    order = sorted(range(40), key=lambda i: (0 if i % 3 == 0 else 1, i))
    assert got == {i: (order.index(i) + 1 if i < 40 and order.index(i) < 20 else None) for i in [*range(40), 99]}


def test_resample_of_nothing(docs):
    assert importance_resampling.resample(docs.limit(0), docs).collect() == []
    got = importance_resampling.resample(docs, docs.limit(0)).collect()
    assert sum(r["rank"] is not None for r in got) > 0


# 13: MinHash near-duplicates


def test_sketch_coordinates_agree_as_often_as_sets(spark):
    rng = np.random.default_rng(1)
    for n, common in ((3000, 2400), (40, 30), (5, 4), (1, 1)):
        shares = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
            a, b = (minhash_dedup.similarity_sketch(s, 200) for s in (pool[:n], pool[n - common :]))
            assert (a != np.uint64(2**64 - 1)).all()
            shares.append(float((a == b).mean()))
        assert abs(np.mean(shares) - common / (2 * n - common)) < 0.03
        assert np.std(shares) < 0.05


def test_sketch_in_one_go_equals_round_by_round():
    rng = np.random.default_rng(2)
    for n, t in ((1, 8), (3, 16), (30, 64), (5000, 64)):
        s = rng.integers(0, 2**63, n, dtype=np.uint64)
        out = {}
        for i in range(2 * t):
            with np.errstate(over="ignore"):
                h = minhash_dedup._mixed(s + np.uint64(i + 1) * minhash_dedup._STEP)
            for x in h:
                place = i - t if i >= t else (int(x) >> 32) * t >> 32
                last = int(x) & (2**48 - 1) if i >= t else int(minhash_dedup._mixed(np.array([x]))[0]) & (2**48 - 1)
                out[place] = min(out.get(place, 2**64), (i << 48) | last)
            if len(out) == t:
                break
        assert minhash_dedup.similarity_sketch(s, t).tolist() == [out[i] for i in range(t)]


def plain_components(rows, width, percent):
    def shingled(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()

    sets = [shingled(r[1]) for r in rows]
    least = list(range(len(rows)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            least[max(root(i), root(j))] = min(root(i), root(j))
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r[0])
    smallest = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(r[0], len(sets[i]), smallest[root(i)]) for i, r in enumerate(rows)]


def near_rows(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(SYLLABLES, k=3))
    rows = [(None, "", "en", "a", 0), (1000, None, None, None, 0), (1000, "one two", "en", "a", 0), (1001, "ONE\ttwo", "en", "a", 0)]
    for group in range(12):
        base = [word() for _ in range(rng.choice([4, 12, 60, 400]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, len(base) // 25, len(base) // 12, len(base) // 8])):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:  # chains: the next is a copy of this one
                base = text
            rows.append((rng.randrange(500), " ".join(text), "en", "a", 0))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_all_pairs(spark, seed):
    ship(spark)
    rows = near_rows(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6).select("*", *[F.lit(-1).alias(name) for name in CLASHING])
    got = [tuple(r) for r in minhash_dedup.near_duplicates(docs).collect()]
    want = plain_components(rows, 4, 80)
    assert collections.Counter(got) == collections.Counter(want)
    assert 12 < len({r[2] for r in want}) < len(rows) - 20


def test_pairs_at_the_threshold(spark):
    """Sets of 90 shingles with 80 in common are linked at exactly 80 %, with 79 they are not."""
    word = lambda of, i: f"w{of}x{i}"
    rows = []
    for pair in range(20):
        for side in (0, 1):
            common = 83 - pair % 2  # so many words hold 80 or 79 shingles
            rows.append((2 * pair + side, " ".join([word(pair, i) for i in range(common)] + [word(f"{pair}y{side}", i) for i in range(93 - common)]), "en", "a", 0))
    assert collections.Counter(c for _, _, c in plain_components(rows, 4, 80)).total() == 40
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {r[0]: r[2] for r in plain_components(rows, 4, 80)}
    assert sum(got[d] != d for d in got) == 10


def test_near_duplicates_of_nothing(docs):
    assert minhash_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_blocks_compare_sketches_of_any_length():
    rng = np.random.default_rng(3)
    made = [minhash_dedup.sketch(rng.integers(0, 2**63, n, dtype=np.uint64)).tobytes() for n in (1, 2, 9, 10, 40, 700, 5000)]
    want = [[minhash_dedup.differing(a, b) for b in made] for a in made]
    assert minhash_dedup.differences(made, made).tolist() == want
    assert minhash_dedup.differences(made[:2], made[:3]).tolist() == [row[:3] for row in want[:2]]


def test_hot_cells_are_cut_into_blocks(spark, monkeypatch):
    """A large group under the threshold, a chain and copies, with blocks of a few rows."""
    monkeypatch.setattr(minhash_dedup, "_PIVOTS", 3)
    monkeypatch.setattr(minhash_dedup, "_MEMBERS", 5)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(0, 200, 4), 6 if i % 3 else 2):
            text[at] = f"x{i}y{at}"
        rows.append((i, " ".join(text), "en", "a", 0))
    got = [tuple(r) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()]
    want = plain_components(rows, 4, 80)
    assert sorted(got) == sorted(want)
    assert 2 < len({r[2] for r in want}) < 60
