"""Operators for training data against brute force, on the small tables and on odd ones."""

import gzip
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import connect, differences
from ctrflow.llm import bpe, jaccard, katz, language, mixing, nearest, queries, substring, topk, toxicity, vectors, warc
from ctrflow.llm.common import Scratch, gram_hashes, one_row_per_id
from ctrflow.llm.components import components
from tests.conftest import executed

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 700}" for i in range(30_000))
ODD = [(1, None), (2, ""), (3, "  \n"), (4, "one"), (5, "a b c d e f g"), (6, "A b C d e f g"), (7, LONG), (8, LONG), (None, "a b c"), (9, "é\x1cü 'll <|endoftext|> x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, an id that is repeated, and other columns with names the operators use."""
    rows = spark.createDataFrame([*ODD, (4, "zzz")], "doc_id long, text string")
    return rows.withColumns({c: F.lit(c) for c in ("id", "bucket", "score", "kept", "ids", "n", "a", "b", "family")})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def texts_of(df):
    """The text that stands for each id."""
    found = {}
    for r in df.select("doc_id", "text").collect():
        if r.doc_id is not None:
            found.setdefault(r.doc_id, []).append(r.text)
    return {i: min((t for t in x if t is not None), default="") for i, x in found.items()}


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert differences(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name]) is None


def test_one_query_per_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


# ---- shared


def test_rolling_hash_is_that_of_the_values():
    h = np.arange(1, 60, dtype=np.uint64) * np.uint64(7919)
    for n in (1, 2, 3, 8, 20, 59):
        grams = gram_hashes(h, n)
        assert len(grams) == 60 - n
        for i in (0, 59 - n):
            assert grams[i] == gram_hashes(h[i:i + n], n)[0]
    assert len(gram_hashes(h[:2], 3)) == 0


def test_components(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, 200), (200, 300), (400, 400), (250, 100)]
    found = components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "t"))
    assert {r.id: r.component for r in found.collect()} == {**dict.fromkeys(range(31), 0), 100: 100, 200: 100, 250: 100, 300: 100}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).isEmpty()


def test_one_row_per_id(odd):
    found = one_row_per_id(odd.select("doc_id", "text"), "doc_id", "text")
    assert {r.id: r.text or "" for r in found.collect()} == texts_of(odd)


# ---- op1


def test_toxicity_on_held_out_rows(spark):
    path = "/root/testdata/sf0.01"
    scores = entry.queries()["op1_toxicity"](spark, path)
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic")
    got = scores.where("held_out").join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    ranks = sorted(got, key=lambda r: r.score)
    good, bad = [i for i, r in enumerate(ranks) if not r.toxic], [i for i, r in enumerate(ranks) if r.toxic]
    area = sum(b > g for b in bad for g in good) / (len(bad) * len(good))
    assert area > 0.9 and not any(r.predicted for r in got if not r.toxic)


def test_toxicity_of_odd_tables(odd, none):
    model = toxicity.fit_toxicity(none.withColumn("toxic", F.lit(1)))
    assert model.score(odd).count() == len(ODD) + 1 and set(r.score for r in model.score(odd).collect()) == {0.5}
    fitted = toxicity.fit_toxicity(odd.withColumn("toxic", F.lit(0)))
    assert all(r.score < 0.5 for r in fitted.score(odd).collect())


def plain_ftrl(rows, dimensions, rounds, passes):
    """One shard, coordinate by coordinate with dictionaries; the score of each text."""
    mask, bias = 2**64 - 1, dimensions

    def mixed(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return (x ^ (x >> 31)) % dimensions

    def coordinates(text):
        h = [xxhash.xxh64_intdigest(w) for w in text.encode().lower().split()]
        found = {mixed(x) for x in h}
        for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
            found |= {mixed((a * salt + b) & mask) for a, b in zip(h, h[gap:])}
        return found

    z, n = Counter(), Counter()

    def weight(i):
        rate = (1 + math.sqrt(n[i])) / 1.0 + 0.01
        if i == bias:
            return -z[i] / rate
        return 0.0 if abs(z[i]) <= 8 else (math.copysign(8, z[i]) - z[i]) / rate

    def score(found):
        return 1 / (1 + math.exp(-sum(weight(i) for i in found) - weight(bias)))

    rows = sorted(((str(i), t.encode(), coordinates(t), y) for i, t, y in rows), key=lambda r: r[:2])
    toxic = sum(y for *_, y in rows)
    balance = max(1.0, (len(rows) - toxic) / toxic)
    for round_ in range(rounds):
        rng = np.random.default_rng(round_)
        for _ in range(passes):
            for k in rng.permutation(len(rows)):
                _, _, found, y = rows[k]
                g = (score(found) - y) * (balance if y else 1.0)
                for i, w in [(i, weight(i)) for i in (*found, bias)]:
                    z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) * w
                    n[i] += g * g
    held = sum(weight(i) != 0 for i in list(z) if i != bias)
    return {int(i): score(found) for i, _, found, _ in rows}, held


def test_toxicity_equals_a_plain_ftrl(spark):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        text = rng.choices([f"w{k}" for k in range(60)], k=rng.randrange(0, 15)) + ["vile", "Rude", "vile"] * (i % 6 == 0)
        rows.append((i, " ".join(text), int(i % 6 == 0 or i % 31 == 0)))
    rows += [(200 + k, "the same text, vile", k % 2) for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(df, dimensions=1 << 12, shards=1, rounds=2, passes=2)
    want, held = plain_ftrl(rows, 1 << 12, 2, 2)
    got = {r.doc_id: r.score for r in model.score(df).collect()}
    assert got == pytest.approx(want, abs=1e-5)
    # L1 keeps the model short
    assert 0 < len(model.coordinates) == held < 1000


# ---- op2, op5


def vector_table(spark):
    inf, nan = float("inf"), float("nan")
    data = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-1.0, 0.5]), (4, None), (5, [None, 1.0]), (6, [nan, 1.0]),
            (7, [inf, 0.0]), (8, [0.0, 0.0]), (9, []), (None, [1.0, 1.0]), (10, [2.0**-99, 2.0**-98]), (11, [3.0])]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>")


def test_top_k_of_odd_vectors(spark):
    good = vectors.finite_vectors(vector_table(spark), "vec_id", "embedding")
    vecs = {0: (1024, 2048), 1: (1024, 2048), 2: (1024, 2048), 3: (-1024, 512), 8: (0, 0), 10: (0, 0), 11: (3072, 0)}
    want = sorted((-(vecs[0][0] * v[0] + vecs[0][1] * v[1]), i) for i, v in vecs.items() if i != 0)[:4]
    got = [(-r.score, r.vec_id) for r in topk.top_k(good, F.col("id") == 0, 4).orderBy("rank").collect()]
    assert got == want
    assert topk.top_k(good.where("id < 0"), F.col("id") == 0).isEmpty()


def test_nearest_of_odd_vectors(spark):
    good = vectors.finite_vectors(vector_table(spark), "vec_id", "embedding")
    got = nearest.nearest(good, F.col("id") == 0, 9).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 10, 11, 3] and got[0].score == pytest.approx(1)
    assert nearest.nearest(good.where("id < 0"), F.col("id") == 0).isEmpty()


# ---- op3


def sets_of(texts, n):
    out = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        out[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    return out


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
@pytest.mark.parametrize("table", ["docs", "odd", "none", "edits"])
def test_jaccard_components(request, spark, table, n, percent):
    if table == "edits":  # chains of copies with more and more words changed, of several lengths
        rng, data = np.random.default_rng(1), []
        for size in (4, 9, 12, 25, 60, 200):
            words = [f"x{size}_{i}" for i in range(size)]
            for step in range(12):
                data.append((len(data), " ".join(words)))
                words[rng.integers(size)] = f"y{step}"
        df = spark.createDataFrame(data, "doc_id long, text string")
    else:
        df = request.getfixturevalue(table)
    got = jaccard.jaccard_components(df, n=n, percent=percent).collect()
    sets = sets_of(texts_of(df), n)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {i: (len(s), find(i)) for i, s in sets.items()}
    assert sum(r.doc_id is None for r in got) == df.where("doc_id IS NULL").count()


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_verifies_no_copies_and_nothing_that_only_shares_a_passage(spark, monkeypatch, n, percent):
    rng = np.random.default_rng(2)
    passages = [" ".join(f"p{k}_{i}" for i in range(40)) for k in range(2)]
    texts = [" ".join([*(f"x{v}" for v in rng.integers(1 << 40, size=300)), passages[k % 2]]) for k in range(60)]
    near = texts[1].replace(texts[1].split()[7], "y")
    data = [*enumerate(texts), *((100 + k, texts[0]) for k in range(8)), (200, near), *((300 + k, near) for k in range(8))]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(8)
    verified, tiles = [], jaccard._open_tiles
    monkeypatch.setattr(jaccard, "LEAST_COMMON", 10 ** 9)  # as in a corpus where no sample has a passage often enough
    monkeypatch.setattr(jaccard, "_open_tiles", lambda members: verified.extend(r.id for r in members.select("id").collect()) or tiles(members))
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(df, n=n, percent=percent).collect()}
    assert found == {i: 0 if t == texts[0] else 1 if t == near else i for i, t in data}
    assert sorted(verified) == [1, 200]


# ---- op4


def test_encoding_equals_the_tokenizers_library(docs, odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.VOCABULARY)
    for df in (docs, odd):
        texts = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
        want = Counter((i, tuple(library.encode(t, add_special_tokens=False).ids)) for i, t in texts)
        encoded = bpe.encode_texts(df, queries.VOCABULARY)
        assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == want
        decoded = bpe.decode_ids(encoded, queries.VOCABULARY)
        assert Counter((r.doc_id, r.text) for r in decoded.collect()) == Counter(texts)
        both = bpe.round_trip(df, queries.VOCABULARY).collect()
        assert Counter((r.doc_id, tuple(map(int, filter(None, r.ids_text.split(","))))) for r in both) == want
        assert Counter((r.doc_id, r.decoded) for r in both) == Counter(texts)
    assert bpe.encode_texts(none, queries.VOCABULARY).isEmpty()


def test_decoding_of_odd_ids():
    pairs = bpe.BytePairs(queries.VOCABULARY)
    assert pairs.decode([10**9, *pairs.encode("ok")]) == "ok"
    assert pairs.decode(pairs.encode("é")[:1]) in ("é", "�")


# ---- op6


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
def test_repeated_windows(request, table):
    df = request.getfixturevalue(table)
    seen, want = set(), {}
    for i, text in sorted(texts_of(df).items()):
        w = text.encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            key = tuple(w[k:k + 20])
            if key in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(key)
        want[i] = len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()
    got = substring.remove_repeats(df).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got if r.doc_id is not None} == want
    assert all(sum(s.length for s in r.removed) == r.n_removed for r in got)
    assert sum(r.doc_id is None for r in got) == df.where("doc_id IS NULL").count()


# ---- op7


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
@pytest.mark.parametrize("training", [True, False])
def test_katz(request, table, training):
    df = request.getfixturevalue(table)
    texts = {i: [*t.encode().lower().split(), None] for i, t in texts_of(df).items()}
    condition = queries.remainder("doc_id", 7) != 2 if training else F.lit(False)
    learned = {i for i in texts if training and zlib.crc32(str(i).encode()) % 7 != 2}
    one, two, after = Counter(), Counter(), Counter()
    for i in learned:
        one.update(texts[i])
        two.update(zip(["<s>", *texts[i]], texts[i]))
        after.update(["<s>", *texts[i][:-1]])
    n, v = sum(one.values()), len(one)
    d1, d2 = (katz.discounts(Counter(c.values())) for c in (one, two))
    less = lambda d, c: d[c] * c if c <= 5 else c
    left = 1 - sum(less(d1, c) for c in one.values()) / n if n else 1.0
    if n and left < 1e-12:
        left = 1 / (n + 1)
    known = (1 - left) / (sum(less(d1, c) for c in one.values()) / n) if n else 0
    p = lambda w: known * less(d1, one[w]) / n if w in one else left
    seen, mass = defaultdict(float), defaultdict(float)
    for (a, b), c in two.items():
        seen[a] += p(b)
        mass[a] += less(d2, c)
    under = {a: c if c - mass[a] > 1e-9 * c else c + 1 for a, c in after.items()}
    alpha = {a: (1 - mass[a] / under[a]) / (1 - seen[a]) for a in after}
    for a in list(after)[:50]:  # probabilities of a history sum to one
        assert sum(less(d2, c) for (x, _), c in two.items() if x == a) / under[a] + alpha[a] * (1 - seen[a]) == pytest.approx(1)
    log = lambda a, b: math.log10(less(d2, two[a, b]) / under[a] if (a, b) in two else alpha.get(a, 1) * p(b))
    got = rows(katz.katz_scores(df, condition))
    assert set(got) == set(texts)
    for i, w in texts.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in one for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w), abs=1e-9)
        assert r.score == pytest.approx(sum(log(a, b) for a, b in zip(["<s>", *w], w)), rel=1e-9, abs=1e-9)


# ---- op8


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "WARC/1.1\r\n\r\n" * 100
    data = [(1, "http://a/x y\r\nz", big), (2, "http://b", big), (3, None, big + "ü"), (4, "", "short"), (5, "u", "short"), (6, "u", None), (2, "http://b", big), (None, "n", big)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("row", F.lit(1))
    path = str(tmp_path / "w")
    warc.write_archives(warc.warc_records(warc.resolve_revisits(pages)), path, archive_bytes=300)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(data)
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in got)
    assert kinds == Counter({(1, "revisit", 2): 1, (2, "response", None): 2, (3, "response", None): 1, (4, "response", None): 1,
                             (5, "response", None): 1, (6, "response", None): 1, (None, "revisit", 2): 1})
    payload = {i: (h or "").encode() for i, _, h in data}
    for r in got:
        assert r.payload_bytes == len(payload[r.page_id]) and r.payload_digest == hashlib.sha1(payload[r.page_id]).hexdigest()
        assert r.payload == (payload[r.page_id] if r.record_type == "response" else b"")
    heads = warc.read_archives(spark, path, payloads=False)
    assert "payload" not in heads.columns and Counter((r.page_id, r.record_type, r.refers_to) for r in heads.collect()) == kinds
    empty = str(tmp_path / "e")
    warc.write_archives(warc.warc_records(warc.resolve_revisits(pages.limit(0))), empty)
    assert warc.read_archives(spark, empty).isEmpty()


def test_warc_references_name_records(spark, tmp_path):
    big = "x" * 5000
    data = [(i % 40, f"http://h/{i}", big + str(i % 7)) for i in range(120)] + [(None, None, "y" * 2000)] * 3
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "w")
    warc.write_archives(warc.warc_records(warc.resolve_revisits(pages)), path, archive_bytes=500)
    records, files = [], [f for f in (tmp_path / "w").glob("part-*.txt") if f.stat().st_size]
    for f in files:
        content = [warc.parse_record(m) for m in warc.members(f.read_bytes())]
        assert content[0][0]["warc-type"] == "warcinfo" and len(content) > 1
        # any reader of gzip reads the file
        assert gzip.decompress(f.read_bytes()).count(b"WARC/1.1\r\n") == len(content)
        records += content
    names = Counter(h["warc-record-id"] for h, _ in records)
    assert len(files) > 3 and max(names.values()) == 1
    by_name = {h["warc-record-id"]: h for h, _ in records}
    revisits = [h for h, _ in records if h["warc-type"] == "revisit"]
    assert revisits and len(records) - len(files) == len(data)
    for h in revisits:
        of = by_name[h["warc-refers-to"]]
        assert of["warc-type"] == "response" and of["warc-payload-digest"] == h["warc-payload-digest"]
        assert of["warc-target-uri"] == h["warc-refers-to-target-uri"] and of["warc-date"] == h["warc-refers-to-date"]
    largest = {}
    for i, _, h in data:
        largest[h] = max(largest.get(h, -1), -1 if i is None else i)
    want = Counter((i, None if i is None or largest[h] == i else largest[h]) for i, _, h in data)
    assert Counter((r.page_id, r.refers_to) for r in warc.read_archives(spark, path).collect()) == want


def test_warc_payloads_that_share_a_slot(spark, monkeypatch):
    # so few bits that every payload is taken for a repeated one
    monkeypatch.setattr(warc, "SLOTS", 1)
    data = [(i, "u", "x" * 1500 + str(i % 5 if i < 20 else i)) for i in range(60)] + [(70, "u", "short")] * 2
    got = warc.resolve_revisits(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    assert Counter((r.page_id, r.original) for r in got) == Counter((i, 15 + i % 5 if i < 15 else None) for i, _, _ in data)
    assert all((r.payload is None) == (r.original is not None) for r in got)


def test_warc_rejects_what_is_no_record():
    with pytest.raises(ValueError):
        warc.parse_record(b"junk")
    with pytest.raises(ValueError):
        list(warc.members(gzip.compress(b"WARC/1.1")[:-3]))


# ---- op9


def test_rates_meet_the_targets(spark, odd, none):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = mixing.fit_domains(queries.labelled_domains(documents, spark.read.parquet(f"{SMALL}/labels.parquet")), list(queries.TARGETS))
    rates = mixing.fit_rates(documents, model, queries.TARGETS, anchor="good", highest=4.0)
    got = rates.collect()
    tokens = {d: sum(r.n_tokens * r[f"p_{d}"] * r.rate for r in got) for d in queries.TARGETS}
    for d, share in queries.TARGETS.items():
        assert tokens[d] / sum(tokens.values()) == pytest.approx(share, abs=2e-3)
    assert all(0 <= r.rate <= 4 and sum(r[f"p_{d}"] for d in queries.TARGETS) == pytest.approx(1) for r in got)
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(t.encode().split()) for i, t in texts_of(documents).items()}
    assert mixing.fit_rates(odd, model, queries.TARGETS).count() == len(ODD) + 1
    assert mixing.fit_rates(none, model, queries.TARGETS).isEmpty()
    assert mixing.fit_rates(odd, mixing.fit_domains(none.withColumn("domain", F.lit("good")), ["good", "low"]), {"good": 1.0}).count() == len(ODD) + 1
    plan = rates._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("low,anchor,highest,within", [(0.07, "good", 4.0, True), (0.7, "good", 4.0, False), (0.7, None, 1.0, False)])
def test_rates_are_least_squares(spark, low, anchor, highest, within):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = mixing.fit_domains(queries.labelled_domains(documents, spark.read.parquet(f"{SMALL}/labels.parquet")), list(queries.TARGETS))
    targets = queries.TARGETS | {"low": low}
    got = mixing.fit_rates(documents, model, targets, anchor=anchor, highest=highest, steps=150).collect()
    p = np.array([[r[f"p_{d}"] for d in queries.TARGETS] for r in got])
    w = np.array([float(r.n_tokens) for r in got])
    share = np.array([targets[d] for d in queries.TARGETS]) / sum(targets.values())
    mass = w @ p
    ratios = [mass[i] / share[i] for i, d in enumerate(queries.TARGETS) if anchor in (None, d)]
    goal = share * min(ratios) / w.sum()
    a = (p * w[:, None]).T / w.sum()
    # plain projected gradient with momentum, step 1 / L, until it stands still
    step = 1 / np.linalg.norm(a @ a.T, 2)
    x = y = np.ones(len(w))
    for k in range(20_000):
        new = np.clip(y - step * a.T @ (a @ y - goal), 0, highest)
        y, x = new + k / (k + 3) * (new - x), new
    best, mine = (float(np.linalg.norm(a @ r - goal)) for r in (x, np.array([r.rate for r in got])))
    assert (best < 1e-3 * goal.sum()) == within
    # Out of reach, the steps end when three in a row gain less than a thousandth, which leaves a percent or so.
    assert mine <= best * 1.02 + 2e-3 * goal.sum()


def test_copies_of_a_rate(spark):
    df = spark.range(20_000).select("id", mixing.taken(F.lit(1.3), F.col("id")).alias("n"))
    assert df.agg(F.avg("n")).first()[0] == pytest.approx(1.3, abs=0.02)
    assert spark.range(9).select(mixing.taken(F.lit(0.995), F.col("id"))).distinct().collect() == [(1,)]


# ---- op10


def test_languages(spark, odd, none):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit_languages(documents)
    got = language.identify(documents, model).join(documents.select("doc_id", F.col("lang").alias("true")), "doc_id").collect()
    assert sum(r.lang == r.true for r in got) >= 0.99 * len(got) and not any(r.rejected for r in got)
    found = rows(language.identify(odd, model, declared="score", host="kept"))
    assert found[1].rejected and found[2].rejected and found[3].rejected and found[1].n_words == 0
    assert language.identify(odd, model).count() == len(ODD) + 1
    assert language.identify(none, model).isEmpty()
    assert all(r.rejected for r in language.identify(odd, language.fit_languages(none.withColumn("lang", F.lit("en")))).collect())


def test_evidence_decides_where_the_text_does_not(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit_languages(documents)
    french = [r.text for r in documents.where("lang = 'fr'").limit(12).collect()]
    data = [(i, t, "fr", "h.fr") for i, t in enumerate(french)] + [(100, "ok", None, "h.fr"), (101, "ok", "fr", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, said string, host string")
    alone, fused = rows(language.identify(df, model)), rows(language.identify(df, model, declared="said", host="host"))
    assert fused[100].lang == "fr" and fused[101].lang == "fr"
    assert fused[100].posterior > (alone[100].posterior if alone[100].lang == "fr" else 0)


def test_common_hosts_change_only_where_rows_meet_their_priors(spark, monkeypatch):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit_languages(documents)
    nth = F.xxhash64("doc_id") % 12
    host = F.when(nth < 4, "hot.fr").when(nth < 9, F.concat(F.lit("h"), nth, F.lit(".de")))  # a third of one host, a few without any
    df = documents.withColumn("host", host).unionByName(documents.limit(20).withColumn("host", F.lit(None).cast("string")))
    found = []
    for share in (1, 8, 1 << 20):  # no host, the hot one and nulls, and every host have their priors broadcast
        monkeypatch.setattr(language, "COMMON", share)
        found.append(sorted(map(tuple, language.identify(df, model, declared="lang", host="host").collect())))
    assert len(found[0]) == df.count() and found[0] == found[1] == found[2]


def test_parts_of_pages(spark):
    df = spark.createDataFrame([("https://u@www.Site.FR:80/a?b", '<!x><HTML class=a lang="Fr-be">'), ("nothing", "<p lang=de>"), (None, None)], "url string, html string")
    got = df.select(language.host_of(F.col("url")), language.suffix_of(language.host_of(F.col("url"))), language.markup_language(F.col("html"))).collect()
    assert [tuple(r) for r in got] == [("www.site.fr", "fr", "Fr"), (None, None, None), (None, None, None)]


# ---- pipeline


def test_pipeline_stages(spark, odd):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL)
        after = Scratch(spark, "test").stage(after, "s")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
        assert after.join(docs, "doc_id", "left_anti").isEmpty() and not after.isEmpty()
        kept.append(after)
        docs = after
    found = jaccard.jaccard_components(kept[1], n=5, percent=80)
    assert found.where("doc_id <> component_id").isEmpty()
    assert substring.remove_repeats(kept[2]).where("n_removed > n_words / 2").count() <= substring.remove_repeats(kept[1]).where("n_removed > n_words / 2").count()
    good = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1 AND toxic = 0")
    lost = kept[2].join(kept[3], "doc_id", "left_anti").join(good, "doc_id").count()
    assert lost <= 0.02 * kept[2].join(good, "doc_id").count()
    shaped = odd.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n_chars"))
    for frame in (shaped, shaped.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, frame, SMALL).collect()


# ---- rows that share an id


@pytest.fixture(scope="module")
def shared(spark):
    """Two equal rows of one id, different texts of one id of which only the larger repeats another document, no ids."""
    word = lambda p, n=40: " ".join(f"{p}{i}" for i in range(n))
    data = [(1, word("a")), (1, word("a")), (2, word("b")), (3, "a short one"), (3, word("b") + " tail of three"),
            (4, word("c")), (4, word("d")), (None, word("a")), (None, word("a"))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    return df.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})


def test_stages_decide_per_row(spark, shared):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    texts = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    given = texts(shared)
    a, b = (next(t for i, t in given if i == k) for k in (1, 2))
    one = texts(stages["n-gram Jaccard join"](spark, shared, SMALL))
    # Stage 2: the equal rows, with and without an id, and the near copy of document 2 go; all other texts stay.
    left = given - Counter({(1, a): 1, (None, a): 2, (3, b + " tail of three"): 1})
    assert one == left
    two = texts(stages["substring dedup"](spark, shared, SMALL))
    assert two == left + Counter({(3, "tail of three"): 1})


def test_stages_decide_about_rows_without_an_id(spark):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = docs.where("lang = 'en' AND n_chars > 400").orderBy("doc_id").first()
    rows_ = [(None, good.text, "en"), (None, good.text, "en"), (5, good.text, "en"), (None, good.text + " 7", "en"), (None, "@@ ## 12", "en"),
             (None, "", None), (9, "... 4", "en"), (9, good.text, "en")]
    df = spark.createDataFrame([(i, t, lang, "s", None) for i, t, lang in rows_], "doc_id long, text string, lang string, source string, n_chars long")
    known = stages["language ID"](spark, docs.unionByName(df), SMALL).where("source = 's'")
    assert Counter(r.doc_id for r in known.collect()) == {None: 3, 5: 1, 9: 1}
    assert [r.doc_id for r in stages["n-gram Jaccard join"](spark, df.where("length(text) > 20"), SMALL).collect()] == [5]
    nameless = df.where("doc_id IS NULL AND length(text) > 20")
    assert stages["n-gram Jaccard join"](spark, nameless, SMALL).count() == 1
    toxic = spark.read.parquet(f"{SMALL}/labels.parquet").where("toxic = 1").select("doc_id")
    many = docs.join(toxic, "doc_id", "left_semi").withColumn("doc_id", F.lit(None).cast("long"))
    many = docs.where("lang = 'en'").unionByName(many.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("n"))
    kept = stages["mixing sources to target weights"](spark, many, SMALL)
    assert 0 < kept.where("doc_id IS NULL").count() < many.where("doc_id IS NULL").count()


def test_queries_return_each_row(spark, shared, tmp_path):
    shared.write.parquet(str(tmp_path / "documents.parquet"))
    want = Counter(r.doc_id for r in shared.collect())
    found = entry.queries()["op3_jaccard"](spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in found) == want
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found)[1, 38, 1] == 2
    found = entry.queries()["op6_substring"](spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in found) == want
    assert sorted(r.n_removed for r in found if r.doc_id == 1) == [0, 40]
    assert sorted((r.n_words, r.n_removed) for r in found if r.doc_id == 3) == [(3, 0), (43, 40)]


def test_rows_without_an_id_meet_no_exchange(spark, shared):
    found = substring.remove_repeats(shared)
    rows_ = [r for r in found.collect() if r.doc_id is None]
    assert [(r.n_words, r.n_removed, r.removed) for r in rows_] == [(40, 0, [])] * 2
    assert {r.kept for r in rows_} == {" ".join(f"a{i}" for i in range(40))}
    # They are a map beside the cogroup instead of rows of it.
    assert "MapInArrow _whole(" in executed(found)


def test_katz_counts_rows_without_an_id(spark, shared, tmp_path):
    """op7 gives what it gives where every row has an id of its own that trains or not like the old one."""
    shared.write.parquet(str(tmp_path / "documents.parquet"))
    found = entry.queries()["op7_katz"](spark, str(tmp_path)).collect()
    given = [(r.doc_id, r.text) for r in shared.collect()]
    trains = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    assert trains(None) and Counter(r.doc_id for r in found) == Counter(i for i, _ in given)
    tokens_ = sum(len(t.split()) + 1 for i, t in given if trains(i))
    assert {r.train_tokens for r in found} == {tokens_} and all(r.held_out != trains(r.doc_id) for r in found)
    single = spark.createDataFrame([(n, t, trains(i)) for n, (i, t) in enumerate(given)], "doc_id long, text string, t boolean")
    want = rows(katz.katz_scores(single, F.col("t")))
    key = lambda r, i: (i is None, i or 0, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6))
    assert sorted(key(r, r.doc_id) for r in found) == sorted(key(want[n], i) for n, (i, _) in enumerate(given))


def test_every_label_is_a_class_at_any_size(spark):
    """Ninety labels, one of them with three rows among thousands of a single one, in an alphabet of its own."""
    word = lambda k, i: "".join(chr(0x100 + 40 * k + (7 * i + j * (i + 3)) % 40) for j in range(5))
    text = lambda k, n: " ".join(word(k, (n * 11 + i) % 60) for i in range(30))
    data = [(n, text(0, n), "l00") for n in range(4000)]
    data += [(10_000 + 10 * k + n, text(k, n), f"l{k:02}") for k in range(1, 90) for n in range(3)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language.fit_languages(df, max_rows=40)
    assert model.languages == [f"l{k:02}" for k in range(90)]
    found = rows(language.identify(df, model, declared="lang"))
    assert all(found[i].lang == lang and not found[i].rejected for i, _, lang in data)
