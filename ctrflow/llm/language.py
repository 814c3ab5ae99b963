"""Language identification by Bayesian fusion of evidence.

The text's likelihood comes from letter trigrams (of bytes) of its words. It is multiplied with the probability of the declared
language given the true one, and with a prior of the host, which is smoothed by that of its address suffix, which is
smoothed by that of all rows. Priors and the reliability of declarations are grouped counts of what the text
alone says; a row is taken out of its own prior. One more class stands for other languages and
letter salad: every trigram is equally likely there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.bpe import _arrow_type
from ctrflow.llm.common import Scratch, text_chunks

#: Hashed trigrams; rows of each label that its likelihoods are fitted on at most (drawn by a hash of id and text).
TRIGRAMS, MAX_ROWS = 1 << 16, 8_000
#: Count of a trigram that a language does not have; classes whose tables a task holds at a time.
LEAST, BLOCK = 0.05, 8
#: Weight of the text's log likelihood, whose trigrams are far from independent.
TEMPER = 0.2
#: Rows that a prior of the level above counts for; prior of the class of other languages.
STRENGTH, OTHER_PRIOR = 20.0, 1e-3
#: Hosts with one row in this many, or more, have their priors broadcast, so these are at most as many, whatever the table.
COMMON = 4096
#: Name of the class of other languages.
OTHER = "und"
#: Characters that belong to no word.
EDGES = b".,;:!?()[]{}<>\"'|*#%&-_/\\=+~^$@0123456789"


def trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams (of bytes) of words, their edges included, one word after the other, and how many each word has.

    Words are lower-cased; what is left of a word without EDGES has as many trigrams as bytes, or none.
    """
    plain = b" ".join([w.strip(EDGES) for w in words]).decode("utf-8", "replace").lower().encode()
    row = np.frombuffer(b" " + plain + b" ", np.uint8).astype(np.uint32)
    code = row[:-2] << np.uint32(16) | row[1:-1] << np.uint32(8) | row[2:]
    inner = row[1:-1] != 32  # a trigram belongs to the word of its middle byte
    word = np.cumsum(~inner)[inner]
    hashed = (code[inner] * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return hashed.astype(np.int64), np.bincount(word, minlength=len(words)) if len(words) else np.zeros(0, np.int64)


def counted_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of texts, each word of the texts by its index, and the number of words of each text."""
    split = [t.split() for t in texts]
    index: dict[bytes, int] = {}
    for words in split:
        for w in words:
            if w not in index:
                index[w] = len(index)
    counts = np.fromiter(map(len, split), np.int64, len(split))
    at = np.concatenate([np.fromiter(map(index.__getitem__, words), np.int32, len(words)) for words in split] or [np.zeros(0, np.int32)])
    return list(index), at, counts


def sums_by(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``counts[i]`` consecutive rows of ``values``."""
    out = np.zeros((len(counts), values.shape[1]))
    full = np.flatnonzero(counts)
    if len(full):
        out[full] = np.add.reduceat(values, (np.cumsum(counts) - counts)[full], axis=0)
    return out


@dataclass
class LanguageModel:
    """Log probabilities of the trigrams of each language, those that it has and the one of all others; the class of other
    languages is last."""

    languages: list[str]
    seen: list[tuple[np.ndarray, np.ndarray]]
    unseen: list[float]

    def block(self, start: int) -> np.ndarray:
        """The table of trigrams by BLOCK classes from ``start`` on."""
        found = np.tile(np.array(self.unseen[start:start + BLOCK]), (TRIGRAMS, 1))
        for i, (at, value) in enumerate(self.seen[start:start + BLOCK]):
            found[at, i] = value
        return found

    def likelihoods(self, df: DataFrame, columns: list[str], text_col: str) -> DataFrame:
        """``columns`` with n_words (words that have letters) and ll, the text's log likelihood in each class."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        plain = df.select(F.struct(*columns).alias("row"), F.col(text_col).cast("string").alias("text"))
        kind = _arrow_type(plain, "row")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            first = model.block(0)
            for rows, texts in text_chunks(batches, 2 << 20):
                words, at, counts = counted_words(texts)
                hashed, size = trigrams(words)
                parts = []
                for start in range(0, len(model.unseen), BLOCK):
                    table = model.block(start) if start else first
                    parts.append(sums_by(sums_by(table[hashed], size)[at], counts))
                n_words = sums_by((size > 0).astype(np.float64)[at, None], counts)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, kind), pa.array(np.rint(n_words).astype(np.int64)), pa.array(list(np.hstack(parts)), pa.list_(pa.float64()))],
                    names=["row", "n_words", "ll"])

        schema = f"row {plain.schema['row'].dataType.simpleString()}, n_words long, ll array<double>"
        return plain.mapInArrow(run, schema).select("row.*", "n_words", "ll")


def fit_languages(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", max_rows: int = MAX_ROWS,
) -> LanguageModel:
    """Likelihoods of all languages that ``label_col`` names, each from about ``max_rows`` of its rows at most and from one at
    least. Without any there is the class of other languages only."""
    rows = df.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("string")), F.lit(1 << 30)).alias("place"))
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"), F.min("place").alias("first")).collect()
    bounds = [(r["label"], max(r["first"], int(min(1.0, max_rows / r["n"]) * (1 << 30)))) for r in sizes]
    bounds = df.sparkSession.createDataFrame(bounds, "label string, bound long")
    rows = rows.join(F.broadcast(bounds), "label").where("place <= bound").select("label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, texts in text_chunks(batches):
            of: dict[str, list[bytes]] = {}
            for label, text in zip(labels, texts):
                of.setdefault(label, []).append(text)
            for label, mine in of.items():
                words, at, _ = counted_words(mine)
                hashed, size = trigrams(words)
                counts = np.bincount(hashed, np.repeat(np.bincount(at, minlength=len(words)), size), TRIGRAMS).astype(np.int64)
                found = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(found), pa.string()), pa.array(found), pa.array(counts[found])], names=["label", "trigram", "n"])

    counts = rows.mapInArrow(count, "label string, trigram long, n long").groupBy("label", "trigram").agg(F.sum("n").alias("n"))
    got = counts.toArrow()
    coded = got.column("label").combine_chunks().dictionary_encode()
    names, code = coded.dictionary.to_pylist(), np.asarray(coded.indices)
    trigram, n = np.asarray(got.column("trigram")), np.asarray(got.column("n")).astype(np.float64)
    order = np.argsort(code, kind="stable")
    ends = np.searchsorted(code[order], np.arange(len(names) + 1))
    languages, seen, unseen = sorted(names), [], []
    for label in languages:
        at = order[ends[names.index(label)]:ends[names.index(label) + 1]]
        total = n[at].sum() + LEAST * TRIGRAMS
        seen.append((trigram[at], np.log((n[at] + LEAST) / total)))
        unseen.append(float(np.log(LEAST / total)))
    return LanguageModel(languages, seen, [*unseen, float(-np.log(TRIGRAMS))])


def host_of(url: Column) -> Column:
    """Lower-case host of an address, null if it has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(F.length(host) > 0, host)


def suffix_of(host: Column) -> Column:
    """What follows the last dot of a host."""
    return F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1))


def markup_language(html: Column) -> Column:
    """The language that an html tag declares."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    return F.when(F.length(found) > 0, found)


def identify(
    df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text: Column | str = "text",
    declared: Column | str | None = None, host: Column | str | None = None, least: float = 0.5,
) -> DataFrame:
    """(id, lang, posterior, rejected, n_words) for every row.

    ``declared`` is the language that markup or metadata declare, ``host`` where the text comes from; either may be null or
    missing, and says nothing then. A row is rejected if it has no words, if its class is that of other languages, or if the
    posterior of its language is below ``least``. Null texts are empty: their language is that of the prior. Null and
    repeated ids are kept. Other columns are not looked at.
    """
    as_column = lambda c: F.col(c) if isinstance(c, str) else F.lit(None).cast("string") if c is None else c
    spark, classes = df.sparkSession, [*model.languages, OTHER]
    scratch = Scratch(spark, "language")
    whole = F.trim(as_column(declared).cast("string"))
    short = F.lower(F.substring(whole, 1, 2))
    known = F.array(*map(F.lit, model.languages)) if model.languages else F.array().cast("array<string>")
    host_ = as_column(host).cast("string")
    prepared = df.select(
        F.col(id_col).alias("id"), as_column(text).cast("string").alias("text"), F.coalesce(host_, F.lit("")).alias("host"),
        F.coalesce(suffix_of(host_), F.lit("")).alias("suffix"),
        F.when(F.array_contains(known, whole), whole).when(F.array_contains(known, short), short).when(F.length(short) > 0, OTHER).otherwise("").alias("declared"))
    rows = scratch.stage(model.likelihoods(prepared, ["id", "host", "suffix", "declared"], "text"), "likelihoods")
    best = F.array_position(F.col("ll"), F.array_max("ll")).cast("int") - 1
    rows = rows.withColumn("guess", F.when(F.col("n_words") > 0, best).otherwise(-1))

    # How far declarations can be trusted: P(declared | language), from rows that declare something. Each pair counts once more.
    pairs, sums = {name: {} for name in classes}, np.full(len(classes), float(len(classes)))
    for r in rows.where("declared <> '' AND guess >= 0").groupBy("guess", "declared").count().collect():
        pairs[r["declared"]][r["guess"]] = float(np.log(r["count"] + 1))
        sums[r["guess"]] += r["count"]
    trust = spark.createDataFrame(list(pairs.items()), "declared string, trust map<int, double>")

    # Sums by class are maps with the classes that occur, so their size does not grow with the number of classes.
    def maps(of: DataFrame, keys: list[str], name: str) -> DataFrame:
        return of.groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(F.struct("guess", "n"))).alias(name), F.sum(F.when(F.col("guess") >= 0, F.col("n")).otherwise(0)).alias(f"{name}_total"))

    by_guess = rows.groupBy("suffix", "host", "guess").agg(F.count("*").alias("n"))
    of_suffix = by_guess.groupBy("suffix", "guess").agg(F.sum("n").alias("n"))
    overall = np.ones(len(classes))
    for r in of_suffix.where("guess >= 0").groupBy("guess").agg(F.sum("n").alias("n")).collect():
        overall[r["guess"]] += r["n"]
    overall = overall / overall.sum() * (1 - OTHER_PRIOR)
    overall[-1] += OTHER_PRIOR
    priors = scratch.stage(maps(by_guess, ["suffix", "host"], "h").join(maps(of_suffix, ["suffix"], "s"), "suffix"), "priors")
    # The rows of a common host stay where they are: there are at most COMMON such hosts. The others meet their priors by shuffle.
    common = F.col("h_total") + F.coalesce(F.col("h")[-1], F.lit(0)) >= rows.count() / COMMON
    keys, often = ["suffix", "host"], F.broadcast(priors.where(common))
    joined = rows.join(often, keys).unionByName(
        rows.join(often.select(keys), keys, "left_anti").join(priors.where(~common), keys)).join(F.broadcast(trust), "declared", "left")
    constants = lambda values: F.array(*[F.lit(float(x)) for x in values])
    seen = (F.col("guess") >= 0).cast("int")

    def score(i: Column) -> Column:
        own = (F.col("guess") == i).cast("int")
        in_suffix = (F.coalesce(F.col("s")[i], F.lit(0)) - own + F.get(constants(STRENGTH * overall), i)) / (F.col("s_total") - seen + STRENGTH)
        in_host = (F.coalesce(F.col("h")[i], F.lit(0)) - own + STRENGTH * in_suffix) / (F.col("h_total") - seen + STRENGTH)
        said = F.when(F.col("declared") == "", 0.0).otherwise(F.coalesce(F.col("trust")[i], F.lit(0.0)) - F.get(constants(np.log(sums)), i))
        return F.get("ll", i) * TEMPER + F.log(in_host) + said

    scores = F.transform(F.sequence(F.lit(0), F.lit(len(classes) - 1)), score)
    joined = joined.withColumn("score", scores).withColumn("most", F.array_max("score"))
    lang = F.element_at(F.array(*map(F.lit, classes)), F.array_position("score", F.col("most")).cast("int"))
    posterior = 1 / F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("most")))
    out = joined.select("id", lang.alias("lang"), posterior.alias("posterior"), "n_words")
    rejected = (F.col("n_words") == 0) | (F.col("lang") == OTHER) | (F.col("posterior") < least)
    return out.select(F.col("id").alias(id_col), "lang", "posterior", rejected.alias("rejected"), "n_words")
