"""Each operator against a plain model, over texts with nulls, repeats, long texts and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tollgate.llm import (
    contextual_pii,
    jaccard_join,
    license_scan,
    line_dedup,
    mixing,
    packing,
    token_files,
    topk_products,
    toxicity,
    weak_quality,
)
from tollgate.llm.common import scratch, ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["size", "part", "node", "key", "id", "line", "label", "score", "rank", "n_words", "slot", "queue", "row", "first", "target"]
SYLLABLES = "an er the ti on re st ou le mi ka zo".split()


def sentence(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def rows_of(seed=1, n=40):
    rng = random.Random(seed)
    lines = [sentence(rng, rng.randint(3, 20)) for _ in range(30)]
    rows = []
    for i in range(n):
        text = "\n".join(rng.choice(lines) if rng.random() < 0.3 else sentence(rng, rng.randint(1, 40)) for _ in range(rng.randint(1, 8)))
        rows.append((i, text, "en", f"src{min(i % 7, 3)}"))
    rows += [(100, None, None, None), (101, "", "en", None), (102, " \t\n ", None, "src0"), (103, "one", "de", ""), (104, "é 日本 \U0001f600 x", "fr", "src1")]
    rows += [(105, rows[3][1], "en", "src0"), (106, rows[3][1], "en", "src0"), (3, rows[3][1], "en", "src3"), (None, "no id here", "en", "src2")]
    rows += [(107, sentence(rng, 30_000), "en", "src1"), (108, "a" * 200_000, "en", "src2"), (109, "7" * 20_000 + " " + "a@" * 5_000, "en", "src2")]
    return [(*row, len(row[1]) if row[1] else 0) for row in rows]


@pytest.fixture(scope="module")
def rows():
    return rows_of()


@pytest.fixture(scope="module")
def docs(spark, rows):
    ship(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(-1).alias(name) for name in CLASHING])


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words(text):
    return WORD.findall(text or "")


# 1: mixing


def test_mix_meets_targets_and_reruns_agree(spark, docs, rows):
    known, mixed = mixing.mix(docs)
    taken = mixing.taken(known, mixed)
    found = taken.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in found) == sorted((r[0] is None, r[0] or 0, len(words(r[1]))) for r in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    by_source = collections.defaultdict(int)
    for r in found:
        by_source[r.source] += r.taken
    assert {r.source: math.floor(r.target) for r in found} == dict(by_source)
    assert math.isclose(sum({r.source: r.target for r in found}.values()), 1.5 * sum(r.size for r in found))
    again = mixing.taken(*mixing.mix(docs)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    slots = [r.slot for r in mixed.select("slot", "source", "block", "epoch").collect()]
    blocks = {(r.source, r.block): r.slot for r in mixed.collect()}
    assert len(set(blocks.values())) == len(blocks) and slots


def test_targets_refill_above_the_cap(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), (None, 1000)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(sizes, 1665.0, [3, 1, 2], 2).collect()}
    # a and b are full at 20 and 200; the rest goes to the last.
    assert found == {"a": 20.0, "b": 200.0, None: 1445.0}


def test_schedule_keeps_shares_in_every_run(spark):
    shares = spark.createDataFrame([(0, 500), (1, 300), (2, 150), (3, 50)], "_number long, share long")
    dealt = sorted((r.slot, r["_number"], r.block) for r in mixing.schedule(shares, 1000).collect())
    assert [d[0] for d in dealt] == list(range(1000))
    ranks = collections.Counter()
    for _, source, block in dealt:
        assert block == ranks[source]
        ranks[source] += 1
    for begin in range(0, 900, 50):
        run = collections.Counter(d[1] for d in dealt[begin : begin + 100])
        assert all(abs(run[s] - share / 10) <= 5 for s, share in enumerate((500, 300, 150, 50)))


def test_mix_of_nothing(none):
    known, mixed = mixing.mix(none)
    assert known.count() == 0 and mixed.count() == 0


# 2: toxicity


def toxic_rows(n, seed):
    rng = random.Random(seed)
    bad = [f"scum{s}" for s in ("my", "bag", "like", "iest", "ly", "er")]
    out = []
    for i in range(n):
        tokens = sentence(rng, rng.randint(5, 60)).split()
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(3):
                tokens.insert(rng.randint(0, len(tokens)), rng.choice(bad))
        out.append((i, " ".join(tokens), toxic))
    return out


def test_toxicity_holds_on_held_out_texts(spark, docs):
    data = spark.createDataFrame(toxic_rows(700, 5), "doc_id long, text string, label int")
    model = toxicity.fit(data.drop("label"), data.where("doc_id < 500").select("doc_id", "label"), sample=500)
    scored = toxicity.score(data.where("doc_id >= 500"), model).join(data, "doc_id").collect()
    right = sum((r.score >= 0.7) == (r.label == 1) for r in scored)
    assert right >= 0.95 * len(scored)
    found = toxicity.score(docs, model).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)


def test_toxicity_without_labels(spark, docs, none):
    assert toxicity.train(["a b", "c"] * 10, [1] * 20) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(none, None).count() == 0


# 3 and 4: tokens


def encoded(rows, name, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [end], "<u4") for r in rows]


ODD = ["a  b", "a   b", " a ", "a \n b", "a\n\n b", "a\t b", "don't  |stop| ", "<|endoftext|> x", "\x1c a", "x　 y", "É É", "  ", "a |", "| | a"]
SPECIAL = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "|endoftext|>"]
ODD += [text.replace("@", s) for s in SPECIAL for text in ("@", "@ x", "a @ b", "a@b  c", "x @", "x@", "\n@\n", " @ ", "@@ @", "| @|")]


@pytest.mark.parametrize("name, end", [("byte_bpe_50k.json", 0), ("word_bpe_49k.json", 2)])
def test_encoder_equals_the_library(name, end):
    from tollgate.llm.encoding import WordEncoder

    rng = random.Random(3)
    texts = ODD + ["".join(rng.choices(["a", "B", " ", "\n", "|", "'s", "é", "é", "12"], k=rng.randint(0, 20))) for _ in range(800)]
    own = WordEncoder(public_tokenizers.path(name), end, max_words=50)
    want = encoded([(0, t) for t in texts], name, end)
    for begin in range(0, len(texts), 100):
        ids, bounds = own.encode(texts[begin : begin + 100])
        for i in range(len(bounds) - 1):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == want[begin + i].tolist(), texts[begin + i]


def test_the_shingles_of_many_words_need_little_memory(monkeypatch):
    monkeypatch.setattr(jaccard_join, "_hashes", {})
    texts = [" ".join(f"w{i}x{k}" for k in range(1000)) for i in range(300)]
    first = [jaccard_join.shingles(text, 5).tolist() for text in texts]
    assert len(jaccard_join._hashes) <= jaccard_join._WORDS + 1000 < 150_000
    assert [jaccard_join.shingles(text, 5).tolist() for text in texts] == first


def test_new_words_are_learnt_together_without_separators(monkeypatch):
    from tollgate.llm.encoding import WordEncoder

    own, calls = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), 0), []
    encode = WordEncoder._encode
    monkeypatch.setattr(WordEncoder, "_encode", lambda self, texts: calls.append(list(texts)) or encode(self, texts))
    own._learn(["plain", "two\nlines", "a|b", "|", "\u0120x", "caf\u00e9\x07s"])
    assert [text for call in calls for text in call] == [" plain two\nlines a|b | \u0120x caf\u00e9\x07s"]
    monkeypatch.undo()
    texts = ["x plain two\nlines a|b | \u0120x caf\u00e9\x07s", "y  end\n next \n", "z \nb c\n d"]
    ids, bounds = own.encode(texts)
    want = encoded([(0, text) for text in texts], "byte_bpe_50k.json", 0)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [w.tolist() for w in want]


def test_words_of_a_vocabulary_that_drops_spaces_are_learnt_together(monkeypatch):
    from tollgate.llm.encoding import WordEncoder

    own, calls = WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2), []
    encode = WordEncoder._encode
    monkeypatch.setattr(WordEncoder, "_encode", lambda self, texts, *by: calls.append(list(texts)) or encode(self, texts, *by))
    own._learn(["plain", "Caf\u00e9,", "don't", "1st", "\u0219i", "o\u0219'"])
    assert max(map(len, calls)) == 1  # all words of one cut in one text


def test_latin_pieces_equal_the_library():
    from tollgate.llm.encoding import WordEncoder

    rng, wide = random.Random(5), [chr(c) for c in (*range(0x250), *range(0x2000, 0x2070), 0x301, 0x307, 0x3A3, 0x4E2D, 0x1F600)]
    latin = [c for c in wide if c < "\u0180"]
    common = [*"aSTrEvMlD' \n\r\t.!12", "'s", "'LL", " 're", "<|", "<|endoftext|>", "\u00c9", "\u00df", "\u00b2", "\u2019"]
    texts = [a + c + b for c in wide for a, b in (("", ""), ("A", "b"), (" ", "'"), (c, c))]
    texts += ["".join(rng.choices(rng.choice([common, common, common + latin, wide]), k=rng.randint(0, 40))) for _ in range(3000)]
    own = WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2, max_words=500)
    want = encoded([(0, t) for t in texts], "word_bpe_49k.json", 2)
    for begin in range(0, len(texts), 100):
        ids, bounds = own.encode(texts[begin : begin + 100])
        for i in range(len(bounds) - 1):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == want[begin + i].tolist(), texts[begin + i]


def test_words_of_a_vocabulary_that_keeps_spaces_are_cut_from_symbols():
    from tollgate.llm.encoding import WordEncoder

    own, name = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), 0), "byte_bpe_50k.json"
    marks = [*".,;:!?)", "\u2019", "...", "\n", "'s", "'ll"]
    texts = [f"So word{a} (word{b} and \u00c9t\u00e9{a}, x2{b} 's" for a in marks for b in marks]
    ids, bounds = own.encode(texts)
    want = encoded([(0, text) for text in texts], name, 0)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [w.tolist() for w in want]
    assert len([w for w in own._index if "word" in w]) <= 2  # behind a space and not
    rng, wide = random.Random(7), [chr(c) for c in (*range(0x250), *range(0x2000, 0x2070), 0x301, 0x4E2D, 0x1F600)]
    texts = [a + c + b for c in wide for a, b in (("", ""), ("A", "b"), (" ", "'"), (c, c), ("a ", " b"))]
    texts += ["".join(rng.choices(rng.choice([ODD, marks + ["a", " ", "  "], wide]), k=rng.randint(0, 30))) for _ in range(1500)]
    own = WordEncoder(public_tokenizers.path(name), 0, max_words=500)
    want = encoded([(0, t) for t in texts], name, 0)
    for begin in range(0, len(texts), 100):
        ids, bounds = own.encode(texts[begin : begin + 100])
        for i in range(len(bounds) - 1):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == want[begin + i].tolist(), texts[begin + i]


def test_token_files_round_trip(spark, docs, rows, none):
    folder = scratch(spark, "test-tokens")
    manifest = token_files.write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), 0, 50_257)
    assert manifest["width"] == 2
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] is not None, rows[i][1] or ""))
    ids = encoded(rows, "byte_bpe_50k.json", 0)
    found = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [rows[i][0] for i in order]
    assert [r.ids for r in found] == [ids[i].tobytes() for i in order]
    assert [r.start for r in found] == (np.cumsum([len(ids[i]) for i in order]) - [len(ids[i]) for i in order]).tolist()
    mapped, offsets, _ = token_files.open_part(folder, manifest["parts"][0]["part"], 2)
    assert isinstance(mapped, np.memmap) and offsets[-1] == len(mapped)
    empty = scratch(spark, "test-tokens")
    token_files.write_tokens(none, empty, public_tokenizers.path("byte_bpe_50k.json"), 0, 50_257)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_packing_holds_every_id_once_in_proportion(spark, docs, rows, none):
    ids = encoded(rows, "word_bpe_49k.json", 2)
    packed = packing.pack(docs.repartition(3), public_tokenizers.path("word_bpe_49k.json"), 2, sequence=64, sequences_per_window=4).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in packed:
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.ids))
        sequences[r.sequence_id].append((r.offset, len(r.ids) // 4, r.padded))
    want = collections.Counter((row[0], x.tobytes()) for row, x in zip(rows, ids))
    single = {key: b"".join(p[1] for p in sorted(found)) for key, found in pieces.items()}
    for (doc, blob), times in want.items():
        if times == 1:
            assert single[doc, len(blob) // 4] == blob
    total = sum(len(x) for x in ids)
    assert sum(len(r.ids) // 4 for r in packed) == total
    assert sorted(sequences) == list(range(-(-total // 64)))
    for number, found in sequences.items():
        at = 0
        for offset, length, padded in sorted(found):
            assert offset == at
            at += length
        assert at == 64 or number == max(sequences)
        assert padded == (at if at & (at - 1) == 0 else 64)
    assert packing.pack(none, public_tokenizers.path("word_bpe_49k.json"), 2).count() == 0


def test_cuts_follow_the_shares_and_never_step_back():
    lengths = np.array([1, 7, 1000, 50_000, 3, 1])
    taken = packing.cuts(lengths, 64, np.arange(900))
    k = np.minimum(np.arange(900) * 64, lengths.sum())
    assert (taken.sum(1) == k).all() and (np.diff(taken, axis=0) >= 0).all()
    assert np.abs(taken - k[:, None] * lengths / lengths.sum()).max() < len(lengths)
    assert (packing.cuts(lengths, 64, np.arange(300, 310)) == taken[300:310]).all()


# 5: near-duplicates


def grams(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets, root = [grams(r[1]) for r in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return collections.Counter((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows))


def near_rows(seed, groups=6, size=40):
    rng = random.Random(seed)
    out, number = [], 0
    passage = sentence(rng, 30)
    for _ in range(groups):
        base = sentence(rng, rng.randint(30, 90)).split()
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(SYLLABLES) + "x"
            if rng.random() < 0.2:
                own += passage.split()
            out.append((number, " ".join(own).upper() if rng.random() < 0.2 else " ".join(own)))
            number += 1
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    rows = near_rows(seed)
    found = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows)


def test_near_duplicates_of_odd_rows(spark, docs, rows, none):
    found = jaccard_join.near_duplicates(docs).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows)
    assert jaccard_join.near_duplicates(none).count() == 0


def family(rng, size, length, kept):
    """Texts over one base, each with words of its own in place of some."""
    base = [f"b{rng.randrange(10**9)}" for _ in range(length)]
    return [" ".join(w if rng.random() < kept else f"o{rng.randrange(10**9)}" for w in base) for _ in range(size)]


def test_blocks_and_regions_equal_brute_force(spark, monkeypatch):
    """Groups under the threshold, cut into small blocks and regions of few centres."""
    for name, value in (("_BLOCK", 7), ("_CENTRES", 3), ("_SMALL", 12), ("_TOGETHER", 40)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(8)
    texts = [t for kept in (0.9, 0.95, 0.985, 0.97) for t in family(rng, 45, rng.randint(30, 140), kept)]
    rows = list(enumerate(texts + texts[:5]))
    found = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows)


@pytest.mark.parametrize("few", [2, 32])
def test_a_pair_leaves_the_blocks_of_one_cell_only(spark, monkeypatch, few):
    """Documents about the threshold share many cells; each pair is compared in full once at most."""
    monkeypatch.setattr(jaccard_join, "_FEW", few, raising=False)
    rng = random.Random(3)
    rows = list(enumerate(family(rng, 70, 120, 0.965)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made, plain = [], type(docs).mapInArrow

    def counted(self, function, schema, *more):
        out = plain(self, function, schema, *more)
        made.append(out.count() if schema == "a long, b long, x long" else 0)
        return out

    monkeypatch.setattr(type(docs), "mapInArrow", counted)
    found = jaccard_join.near_duplicates(docs).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows)
    assert 0 < sum(made) <= 70 * 69 // 2


def test_members_without_a_possible_partner_leave_a_cell(spark):
    rng = random.Random(4)
    rows = list(enumerate(family(rng, 40, 120, 0.97)))
    sets = jaccard_join._sets(spark.createDataFrame(rows, "doc_id long, text string"), 5, 75, 0)
    n = {r.node: r.n for r in sets.collect()}
    cells = collections.defaultdict(list)
    for r in jaccard_join._cells(sets, 75).collect():
        cells[r.cell].append((r.place, r.node))
    assert cells
    for members in cells.values():
        for place, node in members:
            assert (place + min(members)[0]) * 175 <= (n[node] + max(n[x] for _, x in members)) * 25


def test_voronoi_regions_lose_no_pair(monkeypatch):
    """Sketches of several families: the same pairs as all distances give, in far fewer comparisons."""
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 2**63, 120, dtype=np.uint64)
        for _ in range(50):
            own = base.copy()
            change = rng.integers(0, 25)
            own[:change] = rng.integers(0, 2**63, change, dtype=np.uint64)
            sets.append(np.unique(rng.permutation(own)[: rng.integers(100, 120)]))
    k = np.stack([jaccard_join.sketch(s).view(np.uint64) for s in sets])
    n = np.array([len(s) for s in sets])
    compared, distances = [], jaccard_join._distances
    monkeypatch.setattr(jaccard_join, "_distances", lambda a, b: compared.append(len(a) * len(b)) or distances(a, b))
    i, j, x = jaccard_join.voronoi_pairs(k[:400], n[:400], k, n, 75)
    all_ = distances(k[:400], k)
    p, q = np.nonzero(all_ * 175 <= (n[:400, None] + n) * 25)
    assert sorted(zip(i.tolist(), j.tolist(), x.tolist())) == sorted(zip(p.tolist(), q.tolist(), all_[p, q].tolist()))
    assert sum(compared) < 400 * 600 / 3


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id + 1 AS u", "id AS v")
    assert {(r.u, r.v) for r in jaccard_join.components(edges).collect()} == {(i, 0) for i in range(1, 301)}


# 6: personal data

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for number, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), number, m.end(), kind))
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out))


def test_base_spans_equal_the_forms(spark, docs):
    rng = random.Random(9)
    parts = ["a@b.c", "x.y@mail-1.example.com", "@", ".", "_", "1.2.3.4", "256.1.1.1", "001.002.3.4.5.6.7.8", "4539 1488 0343 6467", "4539148803436467", "4539148803436468", "+1 (743) 555-3824", "+", "12", "-", " ", "é", "\U0001f600", "\n", "+49 30 1234567-8"]
    texts = [None, "", "a@b.c_d@e.f"] + ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in contextual_pii.digest(contextual_pii.find_personal_data(df)).collect()}
    for i, text in enumerate(texts):
        want = base_spans(text)
        assert found[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text
        assert set(filter(None, want.split(","))) <= set(found[i].spans.split(","))
        assert found[i].n_email == want.count("email")


def test_contexts_discover_unseen_identifiers(spark):
    rng = random.Random(4)
    seen = [f"please mail to user{i}@host{i}.org about it" for i in range(12)]
    # Not of the known form, but with a shape that known ones have elsewhere would be needed to be taken.
    texts = seen + ["call line +1 555 010 0%02d now" % i for i in range(12)] + ["call line 555 now", "buy 12 apples now"]
    texts += [f"server at 10.0.0.{i} is up" for i in range(12)] + ["server at 300.0.0.1 is up", "chapter 300.0.0.2 is long"]
    texts += [sentence(rng, 20) for _ in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in contextual_pii.digest(contextual_pii.find_personal_data(df)).collect()}
    at = texts.index("server at 300.0.0.1 is up")
    assert found[at] == "ip:10:19"
    assert found[at + 1] == "" and found[texts.index("buy 12 apples now")] == "" and found[texts.index("call line 555 now")] == ""


def test_contexts_discover_identifiers_of_other_shapes(spark):
    texts = [f"call line +1 ({i:03d}) 555-77{i:02d} now" for i in range(12)]
    texts += ["call line 555-010-0203 now", "call line (017) 555-7713 now", "call line 555 now", "take (018) 555-7714 there"]
    cards = [f"4539 1488 0343 {n}" for n in range(6000, 7000) if luhn(f"453914880343{n}")][:12]
    texts += [f"pay with {card} today" for card in cards] + ["pay with 4539 1488 0343 6468 today"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in contextual_pii.digest(contextual_pii.find_personal_data(df)).collect()}
    assert [found[i] for i in range(12, 16)] == ["phone:10:22", "phone:10:24", "", ""]
    assert all(found[i] == "phone:10:27" for i in range(12))
    assert found[len(texts) - 1] == "card:9:28"


def test_personal_data_of_odd_rows(docs, rows, none):
    found = contextual_pii.digest(contextual_pii.find_personal_data(docs)).collect()
    assert len(found) == len(rows)
    want = collections.Counter((r[0], hashlib.sha256(base_spans(r[1]).encode()).hexdigest()) for r in rows)
    assert collections.Counter((r.doc_id, r.base_sha256) for r in found) == want
    assert contextual_pii.find_personal_data(none).count() == 0


# 7: lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_lines(rows, edits, least):
    first = {}
    for doc, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            if len(line) >= least:
                place = (doc is not None, doc or 0, pos)
                first[line] = min(first.get(line, place), place)
    lines = sorted(first, key=first.get)
    gone = {b for i, b in enumerate(lines) for a in lines[:i] if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits}
    out = []
    for doc, text in rows:
        kept = [x for i, x in enumerate((text or "").split("\n")) if len(x) < least or (x not in gone and first[x] == (doc is not None, doc or 0, i))]
        out.append((doc, None if text is None else "\n".join(kept)))
    return collections.Counter(out)


def edited(rng, line):
    i, kind = rng.randrange(len(line)), rng.random()
    return line[:i] + (rng.choice("xyé") if kind < 0.6 else "") + line[i + (kind < 0.9) :]


@pytest.mark.parametrize("edits, seed", [(1, 1), (1, 2), (2, 3)])
def test_line_dedup_equals_brute_force(spark, edits, seed):
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(4, 9)) for _ in range(6)]
    rows = []
    for doc in range(40):
        lines = []
        for _ in range(4):
            line = rng.choice(base)
            for _ in range(rng.randint(0, 3)):
                line = edited(rng, line)
            lines.append(line)
        rows.append((doc, "\n".join(lines)))
    # A group of lines that share a segment, too large for pairs.
    rows += [(100 + i, f"the very same beginning of a line {i:05d}") for i in range(60)]
    rows += [(200, None), (201, ""), (202, "\n\nshort\n"), (203, rows[5][1]), (None, rows[6][1])]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), edits, 20).collect()
    nulls_first = [(doc if doc is not None else -1, text) for doc, text in rows]
    want = collections.Counter({(doc if doc != -1 else None, text): n for (doc, text), n in brute_lines(nulls_first, edits, 20).items()})
    assert collections.Counter((r.doc_id, r.text) for r in found) == want


def test_line_dedup_keeps_columns(docs, rows, none):
    found = line_dedup.dedup_lines(docs)
    assert found.columns == docs.columns and found.count() == len(rows)
    assert line_dedup.dedup_lines(none).count() == 0


# 8: inner products


def test_top_products_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, rng.normal(size=6).astype(float).round(2).tolist()) for i in range(300)]
    vectors += [(300, None), (301, [1.0, None, 2.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [0.5, 0.25])]
    vectors += [(310 + i, vectors[7][1]) for i in range(30)] + [(None, [1.0] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    q = topk_products.quantized(df, "vec_id", "embedding", 1024.0)
    found = topk_products.top_products(q, q.where("vec_id % 10 = 0"), 10).collect()
    usable = {i: [math.floor(1024 * x) for x in v] + [0] * (6 - len(v)) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for i, v in usable.items():
        if i % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in usable.items() if j != i)
            want += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:10], 1)]
    assert sorted(tuple(r) for r in found) == sorted(want)
    assert topk_products.top_products(q.limit(0), q.limit(0)).count() == 0


def test_top_products_move_no_queries_per_block(spark, monkeypatch):
    """Queries are not sent to every block in a shuffle; several slabs, groups and passes give the same as all pairs."""
    monkeypatch.setattr(topk_products, "_SLAB", 50, raising=False)
    monkeypatch.setattr(topk_products, "_QUERIES", 40, raising=False)
    monkeypatch.setattr(topk_products, "_PASS", 3, raising=False)
    rng = np.random.default_rng(2)
    unit, decay = rng.normal(size=(900, 16)), np.exp(-np.arange(16) / 3)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    vectors = np.floor(1024 * unit * decay * rng.lognormal(0, 0.7, (900, 1))).astype(int)
    vectors[100:400] = vectors[rng.integers(0, 5, 300)]
    vectors[400:420] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, v array<long>")
    found = topk_products.top_products(df, df.where("vec_id % 5 = 0"), 10)
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "hashpartitioning(block" not in plan
    want, products = [], vectors @ vectors.T
    for i in range(0, 900, 5):
        best = sorted((-int(s), j) for j, s in enumerate(products[i]) if j != i)[:10]
        want += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in found.collect()) == want


@pytest.mark.parametrize("scale", [1024, 300_000, 2**27], ids="single double integers".split())
@pytest.mark.parametrize("bounded", [0, 1, 4])
def test_slabs_are_searched_exactly(monkeypatch, scale, bounded):
    """Matrix products of either precision and of any form, with ties, zeros, bounds and the query's own id."""
    monkeypatch.setattr(topk_products, "_TILE", (64, 256))
    rng = np.random.default_rng(5)
    unit = rng.normal(size=(1200, 12)) * np.exp(-np.arange(12) / 2)
    m = np.floor(scale * unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.int64)
    for m in (m, rng.integers(-1, 2, (1200, 4)), np.full((1200, 4), 3), np.zeros((1200, 4), np.int64), m[:7]):
        ids, q = np.sort(rng.choice(5000, len(m), replace=False)), m[::9]
        asked = np.concatenate([ids[: len(q) // 2], np.arange(6000, 6000 + len(q) - len(q) // 2)])
        products = q @ m.T
        bounds, bound_ids = np.full(len(q), topk_products._LEAST), np.full(len(q), topk_products._LAST)
        if bounded:
            bounds, bound_ids = np.sort(products, axis=1)[:, max(0, len(m) - 10 * bounded)], rng.choice(5000, len(q))
            bounds[:3], bound_ids[:3], bounds[3:5] = topk_products._LEAST, topk_products._LAST, -(2**62)
        basis = np.ascontiguousarray(np.linalg.eigh(m.T.astype(float) @ m)[1][:, ::-1])
        slab = topk_products._Slab(ids, m, float(np.linalg.norm(m.astype(float), axis=1).max()), basis, 10)
        found = [tuple(map(int, row)) for part in slab.best(asked, q, bounds, bound_ids) for row in zip(*part)]
        want = []
        for a, row, bound in zip(asked, products, zip(-bounds, bound_ids)):
            pairs = sorted((-s, i) for i, s in zip(ids, row) if i != a)
            better = [x for x in pairs if bound[1] == topk_products._LAST or x < bound]
            want += [(int(a), int(i), -int(s)) for s, i in better[:10]]
        assert sorted(found) == sorted(want)


# 9: licenses


def test_license_notices(spark, docs, none):
    filler = sentence(random.Random(1), 300)
    mit = license_scan.TEMPLATES[4][1].replace("any person", "any human person")
    text = f"{filler}\n{mit}\n{filler} released UNDER the mit license, {filler}\nLicensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 3.0."
    found = license_scan.notices(text)
    assert [(name, n) for _, _, name, n, _ in found] == [("MIT", 1), ("MIT", 0), ("CC-BY-NC-4.0", 0)]
    assert text[found[2][0] : found[2][1]] == "Licensed under CC BY-NC 4.0."
    for bad in (None, "", "driving licence lost", "license " * 20_000):
        assert license_scan.notices(bad) == []
    for name, wording in license_scan.TEMPLATES:
        assert {f[2] for f in license_scan.notices(f"{filler} {wording} {filler}")} == {name}
    df = spark.createDataFrame([(1, text, 5), (2, None, 5), (3, filler, 5)], "doc_id long, text string, license int")
    assert {r.doc_id for r in license_scan.scan(df).collect()} == {1}
    assert license_scan.scan(docs).count() == 0 and license_scan.scan(none).count() == 0


# 10: quality


def quality_counts(text):
    w = words(text)
    windows = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts_equal_brute_force(docs, rows, none):
    found = weak_quality.score(docs)
    assert [c for c in docs.columns if c not in weak_quality.ADDED] == [c for c in found.columns if c not in weak_quality.ADDED]
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found.collect())
    assert got == collections.Counter((r[0], *quality_counts(r[1])) for r in rows)
    assert all(not (r.kept and r.base_failed) for r in found.collect())
    assert weak_quality.score(none).count() == 0


def test_quality_tells_junk_from_prose(spark):
    rng = random.Random(2)
    clean = [". ".join(f"the {sentence(rng, 6)} of the {sentence(rng, 4)} and it" for _ in range(8)) + "." for _ in range(120)]
    junk = [" ".join(w + "###" for w in sentence(rng, 60).split()) for _ in range(15)]
    junk += [" | ".join(sentence(rng, 50).split()) for _ in range(15)] + [" ".join(w.upper() + "!!" for w in sentence(rng, 60).split()) for _ in range(15)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(clean + junk)], "doc_id long, text string")
    kept = {r.doc_id for r in weak_quality.score(df).where("kept").collect()}
    assert kept == set(range(len(clean)))


def test_crc_helper_matches_zlib(spark):
    assert spark.sql("SELECT crc32(X'00010203') AS c").first().c == zlib.crc32(bytes(range(4)))
