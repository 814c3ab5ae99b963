"""Collocations, decontamination and Merkle manifests against brute force, on odd tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ctrflow.llm import collocations, decontaminate, merkle
from ctrflow.llm.common import Scratch

NAMES = ("id", "bucket", "score", "kept", "n", "key", "grp", "position", "hash", "prefix", "part", "leaf", "spans", "items", "rank", "f")
LONG = " ".join(f"w{i % 700}" for i in range(30_000))


def wide(df):
    """With further columns of names that the operators use."""
    return df.withColumns({c: F.lit(c) for c in NAMES if c not in df.columns})


# ---- collocations


def brute_collocations(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        known = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in known.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i:i + m]] = max(longest[p[i:i + m]], a)
        found = []
        for p, a in known.items():
            if 100 * longest[p] >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def test_collocations_equal_brute_force(spark):
    parts = ["New York is big. ", "new york city; the end", "the end\x0bthe end the end", "a b a b a b a", "é ü\té ü!é ü", "x  y   z w x y z w", "  ,,, ..", LONG]
    rows = [("en", parts[i % 7] + parts[(3 * i + 1) % 7]) for i in range(60)]
    rows += [(None, "New York new york"), ("und", "new york"), ("de", None), ("de", ""), ("de", "ein Wort"), ("fr", LONG), ("fr", LONG)]
    df = wide(spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string")).repartition(5)
    for least, top in ((3, 2000), (2, 5), (30, 4)):
        found = collocations.collocations(df, Scratch(spark, "t"), least=least, top=top).collect()
        assert sorted(map(tuple, found)) == brute_collocations(rows, least, top)


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(df, Scratch(spark, "t")).isEmpty()
    assert collocations.collocations(spark.createDataFrame([("en", "a b"), (None, None)], df.schema), Scratch(spark, "t")).isEmpty()


def test_a_frequent_prefix_is_dealt_to_many_buckets(spark):
    texts = spark.range(4000).select(F.lit("en").alias("lang"), F.concat_ws(" ", F.lit("hot"), F.lit("pair"), F.expr("'w' || id % 1500")).alias("text"))
    packed = collocations._stripes(texts.select(F.xxhash64("lang"), F.col("text").cast("binary")), 1, 64, spark.sparkContext.broadcast(b"\xff" * 4096), 15)
    assert packed.select("bucket").distinct().count() > 30


# ---- decontamination


def word_list(text):
    return [w.lower() for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text or "")]


def brute_hits(words, items, least):
    """Positions of hit words and the items that hit."""
    hit, names = set(), set()
    for name, item in items:
        k = min(len(item), least)
        windows = {tuple(item[i:i + k]) for i in range(len(item) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i:i + k]) in windows:
                hit |= set(range(i, i + k))
                names |= {name}
    return hit, names - {None}


BENCH = [
    (1, "the quick brown fox jumps over the lazy dog again and again until night falls"), (2, "short item"), (3, "ONE"), (4, None), (5, " -- "),
    (6, "over the lazy dog again and again until night falls on the town"), (7, "a b a b a b a b a b a b a"), (2, "other text of the same id"),
    (None, "an item without any id"), (8, " ".join(f"w{i % 700}" for i in range(900))), (9, "b a b"), (10, "lazy dog"),
]


def documents(spark):
    rows = [
        (1, None), (2, ""), (3, "  \n"), (4, BENCH[0][1]), (5, "xx " + BENCH[0][1].upper() + " yy"), (6, "It was ONE, short-item! other text"),
        (7, "a b a b a b a b a b a b a b c a b a b"), (8, LONG), (8, "short item short item"), (None, "an item; without any id"), (None, "nothing here"),
        (9, "quick brown fox jumps over the lazy dog again and again until night falls on the town and more"), (10, "b a b a b"), (4, BENCH[0][1]),
    ]
    return rows, wide(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)


@pytest.mark.parametrize("pass_words", [300_000, 400])
@pytest.mark.parametrize("least", [10, 4, 1])
def test_hits_equal_brute_force(spark, monkeypatch, pass_words, least):
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 150)
    rows, df = documents(spark)
    bench = wide(spark.createDataFrame(BENCH, "item_id long, text string"))
    found = decontaminate.contamination(df, bench, Scratch(spark, "t"), min_words=least, pass_words=pass_words).collect()
    items = [(None if i is None else str(i), word_list(t)) for i, t in BENCH]
    expected = []
    for i, text in rows:
        hit, names = brute_hits(word_list(text), items, least)
        expected.append((i, len(word_list(text)), len(hit), sorted(names), sorted(hit)))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], [p for s in r.spans for p in range(s.start, s.end)]) for r in found]
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_automaton_survives_the_way_through_arrays():
    automaton = decontaminate.Automaton()
    rows = [("a", b"x y z x y".split(), False), ("b", b"y z".split(), True)]
    for _, words, _ in rows:
        automaton.add(words)
    automaton.finish(3, rows)
    again = decontaminate.Automaton.unpack(automaton.pack())
    for text in (b"x y z x y q y z", b"z x y z", b""):
        assert automaton.scan(text.split()) == again.scan(text.split())
    assert again.scan(b"q y z x y z q".split()) == ([(1, 6)], {"a", "b"})


def test_empty_tables(spark):
    _, df = documents(spark)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert decontaminate.contamination(df.limit(0), bench, Scratch(spark, "t")).isEmpty()
    clean = decontaminate.contamination(df, bench.limit(0), Scratch(spark, "t"))
    assert clean.count() == df.count() and clean.where("n_hit > 0").isEmpty()


def test_spans_are_cut_and_covered_rows_dropped(spark):
    _, df = documents(spark)
    bench = spark.createDataFrame(BENCH[:1], "item_id long, text string")
    kept = decontaminate.decontaminate(df, bench, Scratch(spark, "t"), max_coverage=0.9)
    assert kept.columns == df.columns
    texts = {(r.doc_id, r.text) for r in kept.collect()}
    assert (4, BENCH[0][1]) not in texts and not [t for i, t in texts if i == 4]
    assert (5, "xx  yy") in {(i, t) for i, t in texts} or 5 not in {i for i, _ in texts}
    assert (9, " on the town and more") in texts and (1, None) in texts and (None, "nothing here") in texts
    assert kept.count() == df.count() - 2 and (8, LONG) in texts
    whole = decontaminate.decontaminate(df, bench, Scratch(spark, "t"), max_span=15)
    assert whole.count() == df.count() and (9, documents(spark)[0][11][1]) in {(r.doc_id, r.text) for r in whole.collect()}


# ---- Merkle


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(leaves):
    """Root and, of each leaf, the siblings by level."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for path, i in zip(paths, at):
            run = range(i // 3 * 3, min(i // 3 * 3 + 3, len(level)))
            path.append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
        level, at = [h(*level[i:i + 3]) for i in range(0, len(level), 3)], [i // 3 for i in at]
    return (level[0] if level else None), paths


def brute_manifest(rows):
    groups = defaultdict(list)
    for i, source, leaf in rows:
        groups[source].append(((i is not None, i or 0, leaf), i, leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort()
        trees[s] = brute_tree([leaf for _, _, leaf in groups[s]])
    root, over = brute_tree([trees[s][0] for s in order])
    return sorted(
        (str(i), leaf, trees[s][0], root, h(*[a + b for a, b in own + up]))
        for s, up in zip(order, over) for (_, i, leaf), own in zip(groups[s], trees[s][1]))


@pytest.mark.parametrize("block_levels", [5, 2])
def test_manifest_equals_brute_force(spark, monkeypatch, block_levels):
    monkeypatch.setattr(merkle, "LEVELS", block_levels)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** block_levels)
    rows = [(i, ("hot" if i % 3 else f"s{i % 33}"), f"text {i}\n") for i in range(700)]
    rows += [(7, "hot", "again"), (7, "hot", "again"), (None, "hot", "no id"), (None, "hot", None), (1, None, "x"), (2, "", None), (3, "é", ""), (4, "one", LONG), (8, "ab", "a"), (9, "ab", "b")]
    df = wide(spark.createDataFrame(rows, "doc_id long, source string, text string")).repartition(7)
    columns = [F.col(c) for c in ("doc_id", "source", "text")]
    made = merkle.merkle_manifest(df, "doc_id", "source", merkle.leaf_hash(*columns), Scratch(spark, "t"), {"text": F.col("text")})
    found = made.rows.select("id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("p"), merkle.fold(F.col("leaf"), F.col("path")).alias("f")).collect()
    assert sorted((str(r.id), r.leaf, r.subroot, r.root, r.p) for r in found) == brute_manifest([(i, s, leaf_of(i, s, t)) for i, s, t in rows])
    assert all(r.f == r.root for r in found)
    wrong = made.rows.withColumn("leaf", F.sha2("leaf", 256))
    assert wrong.where(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).isEmpty()
    sizes = {r.group: r.n_rows for r in made.groups.collect()}
    assert sizes == Counter(s for _, s, _ in rows)


def test_manifest_of_an_empty_table_and_of_one_row(spark):
    schema = "doc_id long, source string, text string"
    leaf = merkle.leaf_hash(F.col("doc_id"), F.col("text"))
    empty = merkle.merkle_manifest(spark.createDataFrame([], schema), "doc_id", "source", leaf, Scratch(spark, "t"))
    assert empty.rows.isEmpty() and empty.groups.isEmpty()
    one = merkle.merkle_manifest(spark.createDataFrame([(1, None, None)], schema), "doc_id", "source", leaf, Scratch(spark, "t")).rows.first()
    assert one.leaf == one.subroot == one.root == leaf_of(1, None) and one.path == []


def test_tampered_rows_of_the_query_are_found(spark):
    import __spark_entry__ as entry

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in entry.queries()["op13_merkle"](spark, "/root/testdata/sf0.001").collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 2 == 1 or "\n" not in (docs[r.doc_id] or ""))
