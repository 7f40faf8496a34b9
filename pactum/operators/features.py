"""Model features: one-hot, group split, exact TF-IDF, scaling, PCA, token sequences.

Design notes
* Category lists, vocabularies and PCA loadings are *bounded model state*
  (tens to hundreds of entries): they are computed by Spark aggregates and
  held on the driver like any fitted ML model.  Rows never are.
* TF-IDF follows the classic smooth-idf definition (``ln((1+n)/(1+df)) + 1``,
  raw term counts, L2 row norm, vocabulary = N most frequent terms); the
  long form (doc, term, weight) is made row by row in Arrow, the vector form too where
  the texts' distinct words are known, else by Spark ML's ``CountVectorizerModel`` +
  ``ElementwiseProduct`` + ``Normalizer`` (JVM side, sparse).
* Scaling uses the population standard deviation; a constant column scales to 0.
* The group split orders distinct group ids by ``md5(id || seed)`` so that the
  same split is reproducible in SQL engines; cut points follow
  ``int(0.7 n)``, ``int(0.85 n)`` of the number of groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorSizeHint
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from pactum.functions.text import tfidf_tokens
from pactum.operators.coded import count_words, lookup, lookup_vectors, split_tokens
from pactum.operators.indexing import dense_index
from pactum.session import durable

# ------------------------------------------------------------------ one-hot


MAX_CATEGORIES = 10_000


def categories(df: DataFrame, col: str) -> list:
    """Sorted distinct non-null values of a categorical column; more than MAX_CATEGORIES is an error."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"{col} has more than {MAX_CATEGORIES} values; it is no categorical column")
    return sorted(r[0] for r in rows)


def one_hot_drop_first(df: DataFrame, cols: Sequence[str], levels: dict | None = None) -> DataFrame:
    """One 0/1 column ``col_value`` per category except the first; NULL -> all 0; sources dropped."""
    levels = dict(levels or {})
    new = {}
    for c in cols:
        cats = levels.get(c) or categories(df, c)
        for v in cats[1:]:
            new[f"{c}_{v}"] = F.when(F.col(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0)).cast("int")
    return df.withColumns(new).drop(*cols)


# ------------------------------------------------------------------ group split

SPLITS = ("train", "cv", "test")


def _group_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"#{seed}")))


def group_order(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """(key, rank, n_groups): distinct groups in a seeded pseudo-random order."""
    keys = df.select(key).distinct().withColumn("__h", _group_hash(key, seed))
    ranked = dense_index(keys, ["__h", key], out="rank")
    n = keys.select(F.count(F.lit(1))).scalar()
    return ranked.select(key, "rank", n.alias("n_groups"))


def group_split(df: DataFrame, key: str, fractions: Sequence[float] = (0.7, 0.15), seed: int = 0) -> DataFrame:
    """Add ``split`` in train/cv/test so that every group lands in exactly one split.

    Groups are ranked by themselves; the two groups at the cuts then tell every
    row its side by its own hash and key, so whole rows are neither joined nor
    moved.  Rows without a key are one group, which comes before equal hashes.
    """
    order = group_order(df, key, seed)
    a, b = (F.floor(F.col("n_groups") * F.lit(f)) for f in (fractions[0], fractions[0] + fractions[1]))
    cuts = order.where((F.col("rank") == a) | (F.col("rank") == b)).select(
        (F.col("rank") == a).alias("a"), (F.col("rank") == b).alias("b"), F.col(key).alias("key"),
        _group_hash(key, seed).alias("h")).collect()   # two rows

    def before(cut) -> Column:
        if cut is None:
            return F.lit(True)
        tie = F.lit(False) if cut["key"] is None else F.col(key).isNull() | (F.col(key) < F.lit(cut["key"]))
        return (_group_hash(key, seed) < F.lit(cut["h"])) | ((_group_hash(key, seed) == F.lit(cut["h"])) & tie)

    first, second = (next((c for c in cuts if c[side]), None) for side in "ab")
    return df.withColumn("split", F.when(before(first), "train").when(before(second), "cv").otherwise("test"))


# ------------------------------------------------------------------ TF-IDF

MAX_HOLDERS = 100_000  # words that hold a term: so many are looked up by name
TF_ROWS = 1_000        # texts whose terms are counted at once


def word_counts(docs: DataFrame, text_col: str, counted: Column | None = None) -> DataFrame:
    """(word, n): single-space words of all texts; the only shuffle is of a batch's distinct words.

    With ``counted`` n is of the rows where it is true, and 0 for the words of the others alone.
    """
    return count_words(docs, text_col, counted)


def stored_words(docs: DataFrame, text_col: str, counted: Column | None = None) -> DataFrame:
    """``word_counts``, written once."""
    return durable(word_counts(docs, text_col, counted), "word-counts")


class Holders(NamedTuple):
    """The words that hold a term, and the places of theirs: of word k those from ``first[k]`` up to ``first[k + 1]``."""

    words: pa.Array
    first: np.ndarray
    places: np.ndarray
    n_terms: int

    def counts(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, matrix of rows x terms): how often each text holds each term, ``TF_ROWS`` texts at a time."""
        for at in range(0, len(texts), TF_ROWS):
            tokens, offsets = split_tokens(texts.slice(at, TF_ROWS))
            n = len(offsets) - 1
            code = pc.index_in(tokens, value_set=self.words)
            known = code.is_valid().to_numpy(zero_copy_only=False)
            row, code = np.repeat(np.arange(n), np.diff(offsets))[known], code.drop_null().to_numpy()
            each = (self.first[1:] - self.first[:-1])[code]
            within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            place = self.places[np.repeat(self.first[code], each) + within]
            cells = np.bincount(np.repeat(row, each) * self.n_terms + place, minlength=n * self.n_terms)
            yield at, cells.reshape(n, self.n_terms)


def word_holders(words: DataFrame, terms: Sequence[str]) -> Holders | None:
    """Which of ``words`` (word, n) hold which of the terms; None if they are more than ``MAX_HOLDERS``.

    A term holds no space, so the terms of a text are those of its words: the pattern runs once per distinct word, and
    texts that have no other words are counted by name.
    """
    held = words.select("word", F.filter(tfidf_tokens("word"), lambda t: t.isin(list(terms))).alias("held"))
    found = held.where(F.size("held") > 0).limit(MAX_HOLDERS + 1).collect()
    if len(found) > MAX_HOLDERS:
        return None
    place = {t: i for i, t in enumerate(terms)}
    return Holders(pa.array([r["word"] for r in found], pa.string()),
                   np.cumsum([0, *(len(r["held"]) for r in found)]),
                   np.array([place[t] for r in found for t in r["held"]], np.int64), len(place))


def term_totals(docs: DataFrame, text_col: str, words: DataFrame | None = None) -> DataFrame:
    """(term, total): occurrences per term.

    A term holds no space, so the terms of a text are those of its words: the
    pattern runs once per distinct word (``words``, the word counts of ``docs``,
    where they are known) and not over every text.
    """
    words = word_counts(docs, text_col) if words is None else words
    return words.select(F.explode(tfidf_tokens("word")).alias("term"), "n").groupBy("term").agg(F.sum("n").alias("total"))


def document_counts(docs: DataFrame, text_col: str, terms: Sequence[str], words: DataFrame | None = None) -> DataFrame:
    """(term, df): documents that hold each of the given terms (a bounded list, as a vocabulary is).

    ``words`` are the word counts of ``docs``, where they are known: if the words
    that hold a term are few, texts are split and looked up, and not matched.
    """
    holders = None if words is None else word_holders(words, terms)
    if holders is None:
        held = F.array_distinct(F.filter(tfidf_tokens(text_col), lambda t: t.isin(list(terms))))
        return docs.select(F.explode(held).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    names = pa.array(terms, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), np.int64)
        for b in batches:
            for _, tf in holders.counts(b.column(0)):
                total += (tf > 0).sum(0)
        yield pa.RecordBatch.from_arrays([names, pa.array(total)], ["term", "df"])

    each = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "term string, df long")
    return each.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")


def tfidf_fit(docs: DataFrame, id_col: str, text_col: str, n_terms: int, words: DataFrame | None = None) -> DataFrame:
    """Vocabulary table (term, df, idf, col) fitted on ``docs``; col = alphabetical position.

    The texts' words are counted once and stored (``words``, where they are).  The terms are picked by
    their totals first; only theirs are then counted by document.  The result
    is fitted once: ``n_terms`` rows, held like any model.
    """
    spark, columns = docs.sparkSession, "term string, df long, idf double, col long"
    words = stored_words(docs, text_col) if words is None else words
    top = term_totals(docs, text_col, words).orderBy(F.col("total").desc(), F.col("term")).limit(n_terms)
    terms = sorted(r["term"] for r in top.collect())   # bounded: n_terms rows
    if not terms:
        return spark.createDataFrame([], columns)
    held = {r["term"]: r["df"] for r in document_counts(docs, text_col, terms, words).collect()}   # bounded: n_terms rows
    n_docs = docs.count()
    return spark.createDataFrame([(t, held[t], math.log((1 + n_docs) / (1 + held[t])) + 1.0, i)
                                  for i, t in enumerate(terms)], columns)


def vocabulary_holders(words: DataFrame, vocab: DataFrame) -> Holders | None:
    """The words that hold a term of the vocabulary, for ``tfidf_transform`` and ``tfidf_vectors``.

    ``words`` has all words of the texts that are transformed.
    """
    terms = [r["term"] for r in vocab.orderBy("col").select("term").collect()]   # bounded: n_terms rows
    return word_holders(words, terms) if terms else None


def _weights(tf: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of the non-zero entries of L2-normed rows, in order."""
    row, col = np.nonzero(tf)
    weight = tf[row, col] * idf[col]
    return row, col, weight / np.sqrt(np.bincount(row, weight * weight, len(tf)))[row]


def tfidf_transform(docs: DataFrame, vocab: DataFrame, id_col: str, text_col: str, holders: Holders | None = None) -> DataFrame:
    """Long form (id, term, col, weight): the non-zero entries of the documents' L2-normed vectors.

    A row's tokens are looked up, counted and weighted inside the row (Arrow, NumPy); only non-zero entries ever exist.
    With ``holders`` texts are split and looked up, without them their tokens are matched first.
    """
    rows = vocab.orderBy("col").select("term", "idf").collect()   # bounded: n_terms rows
    kind = docs.schema[id_col].dataType
    schema = StructType([StructField(id_col, kind), StructField("term", StringType()), StructField("col", LongType()),
                         StructField("weight", DoubleType())])
    if not rows:
        return docs.sparkSession.createDataFrame([], schema)
    terms, idf = pa.array([r["term"] for r in rows], pa.string()), np.array([r["idf"] for r in rows])
    text = F.col(text_col).cast("string")
    if holders is None:
        holders = Holders(terms, np.arange(len(terms) + 1), np.arange(len(terms)), len(terms))
        text = F.array_join(tfidf_tokens(text_col), " ")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, tf in holders.counts(b.column(1)):
                row, col, weight = _weights(tf, idf)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at + row)), terms.take(pa.array(col)),
                                                  pa.array(col, pa.int64()), pa.array(weight)], schema.names)

    return docs.select(id_col, text.alias("__t")).mapInArrow(entries, schema)


def tfidf_fit_transform(docs: DataFrame, id_col: str, text_col: str, n_terms: int):
    """(vocabulary, long weights) of the same documents."""
    words = stored_words(docs, text_col)
    vocab = tfidf_fit(docs, id_col, text_col, n_terms, words)
    return vocab, tfidf_transform(docs, vocab, id_col, text_col, vocabulary_holders(words, vocab))


_SPARSE = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])


def tfidf_vectors(docs: DataFrame, vocab: DataFrame, text_col: str, out: str = "tfidf", holders: Holders | None = None) -> DataFrame:
    """Sparse vector column: CountVectorizer(vocab) -> x idf -> L2 normaliser (all JVM).

    Tokens outside the vocabulary count for nothing, and are dropped before a row leaves Spark's own format.
    A null text has no token.  With ``holders`` (of words that the texts are made of) texts are split and looked up
    instead, and the text itself is dropped: it does not come back from where its words are counted.
    """
    rows = vocab.orderBy("col").select("term", "idf").collect()   # bounded: n_terms rows
    terms = [r["term"] for r in rows]
    if holders is not None:
        return _looked_up_vectors(docs, np.array([r["idf"] for r in rows]), text_col, out, holders)
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol="__tok", outputCol="__tf")
    scaled = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="__tf",
                                outputCol="__tfidf")
    norm = Normalizer(p=2.0, inputCol="__tfidf", outputCol=out)
    known = F.filter(tfidf_tokens(text_col), lambda t: t.isin(terms))
    df = docs.withColumn("__tok", F.coalesce(known, F.array().cast("array<string>")))
    return norm.transform(scaled.transform(cv.transform(df))).drop("__tok", "__tf", "__tfidf")


def _looked_up_vectors(docs: DataFrame, idf: np.ndarray, text_col: str, out: str, holders: Holders) -> DataFrame:
    keep = [f for f in docs.schema.fields if f.name != text_col]
    schema = StructType([*keep, StructField(out, VectorUDT())])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, tf in holders.counts(b.column(len(keep))):
                row, col, weight = _weights(tf, idf)
                ends = pa.array(np.searchsorted(row, np.arange(len(tf) + 1)), pa.int32())
                made = [np.zeros(len(tf), np.int8), np.full(len(tf), len(idf), np.int32),
                        pa.ListArray.from_arrays(ends, pa.array(col, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(weight))]
                vec = pa.StructArray.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in made], fields=list(_SPARSE))
                kept = b.slice(at, len(tf)).columns[:len(keep)]
                yield pa.RecordBatch.from_arrays([*kept, vec], schema.names)

    texts = docs.select(*[F.col(f"`{f.name}`") for f in keep], F.col(text_col).cast("string").alias("__text"))
    # what follows asks the column for its size
    return VectorSizeHint(inputCol=out, size=len(idf), handleInvalid="optimistic").transform(texts.mapInArrow(vectors, schema))


def expand_vector(df: DataFrame, col: str, prefix: str, n: int, start: int = 1) -> DataFrame:
    """Vector -> columns ``prefix{start}..``; the dense ``feat_text_i`` layout."""
    arr = vector_to_array(F.col(col))
    return df.withColumns({f"{prefix}{i + start}": arr[i] for i in range(n)}).drop(col)


# ------------------------------------------------------------------ scaling


def standard_scale(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """z-score with the population std (one aggregate pass, merged scalar subqueries)."""
    out = {}
    for c in cols:
        x = F.col(c).cast("double")
        mean = df.select(F.avg(x)).scalar()
        std = df.select(F.stddev_pop(x)).scalar()
        out[c + suffix] = F.when(std == 0, F.lit(0.0)).otherwise((x - mean) / std)
    return df.withColumns(out)


# ------------------------------------------------------------------ PCA


def standard_scale_vector(df: DataFrame, col: str, out: str) -> DataFrame:
    """Population-std z-score of a vector column with Spark ML (one pass, JVM).

    ``StandardScaler`` divides by the sample std; multiplying by
    sqrt(n / (n - 1)) gives the population form.  Constant entries stay 0.
    """
    from pyspark.ml.feature import StandardScaler

    n = df.count()
    model = StandardScaler(withMean=True, withStd=True, inputCol=col, outputCol="__zs").fit(df)
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    d = len(model.mean)
    fix = ElementwiseProduct(scalingVec=Vectors.dense([factor] * d), inputCol="__zs", outputCol=out)
    return fix.transform(model.transform(df)).drop("__zs")


class PcaModel:
    """Centred PCA with deterministic signs, applied with Spark ML stages (JVM)."""

    def __init__(self, centre, pca, signs, k):
        self.centre, self.pca, self.signs, self.k = centre, pca, signs, k

    def transform(self, df: DataFrame, col: str, out: str = "pca") -> DataFrame:
        c = self.centre.setInputCol(col).setOutputCol("__c").transform(df)
        p = self.pca.setInputCol("__c").setOutputCol("__p").transform(c)
        s = ElementwiseProduct(scalingVec=Vectors.dense(self.signs), inputCol="__p", outputCol=out).transform(p)
        return s.drop("__c", "__p")

    def transform_columns(self, df: DataFrame, col: str, prefix: str = "pca_") -> DataFrame:
        return expand_vector(self.transform(df, col, "__pca"), "__pca", prefix, self.k, start=0)


def pca_fit(df: DataFrame, col: str, k: int) -> PcaModel:
    """Centre (mean only), fit Spark ML PCA (distributed Gramian, k x d result on the
    driver), and fix each component's sign so its largest-magnitude loading is positive."""
    import numpy as np
    from pyspark.ml.feature import PCA as _PCA
    from pyspark.ml.feature import StandardScaler

    centre = StandardScaler(withMean=True, withStd=False, inputCol=col, outputCol="__c").fit(df)
    pca = _PCA(k=k, inputCol="__c", outputCol="__p").fit(centre.transform(df).select("__c"))
    pc = np.array(pca.pc.toArray(), dtype=float, copy=True)   # d x k
    signs = [1.0 if pc[int(np.argmax(np.abs(pc[:, j]))), j] >= 0 else -1.0 for j in range(pc.shape[1])]
    return PcaModel(centre, pca, signs, k)


# ------------------------------------------------------------------ token sequences


def vocabulary_from_frequency(words: DataFrame, k: int, word_col: str = "word", count_col: str = "n") -> DataFrame:
    """(word, rank): the ``k`` most frequent words (ties by word), ranked 0..k-1 by the distributed dense index."""
    ranked = dense_index(words.select(word_col, (-F.col(count_col)).alias("__n")), ["__n", word_col], out="rank")
    return ranked.filter(F.col("rank") < k).select(word_col, "rank")


def vectorize_tokens(df: DataFrame, id_col: str, text_col: str, emb: DataFrame,
                     token_col: str = "word", vec_col: str = "vec", out: str = "seq", keep: Sequence[str] = ()) -> DataFrame:
    """(id, keep..., out): the values of the text's known words in order; unknown words dropped, no known word -> empty.

    Words meet the embedding table once per block of texts (``coded.py``).  What
    a later step needs beside the sequences is kept on the row: vectors are some
    forty times the bytes of their words, and a join would move them.
    """
    source = df.select(id_col, *keep, text_col)
    if isinstance(emb.schema[vec_col].dataType, ArrayType):
        return lookup_vectors(source, text_col, emb, token_col, vec_col, out)
    return lookup(source, text_col, emb, token_col, vec_col, out)


def length_batches(df: DataFrame, id_col: str, seq_col: str, batch_rows: int) -> DataFrame:
    """(id, batch, n_steps): rows in order of their length, ``batch_rows`` to a batch; n_steps = the batch's longest.

    Rows of like length share a batch, so padding a batch to its longest adds
    little.  Only ids and lengths are ranked (range partitions); a batch's
    longest row is the one of its last rank.  ``seq_col`` may hold the lengths instead.
    """
    size = F.size(seq_col) if isinstance(df.schema[seq_col].dataType, ArrayType) else F.col(seq_col)
    sizes = df.select(F.col(id_col).alias("__id"), size.alias("__size"))
    ranked = dense_index(sizes, ["__size", "__id"], out="__rank")
    batch = F.floor(F.col("__rank") / F.lit(batch_rows))
    longest = ranked.groupBy(batch.alias("__b")).agg(F.max("__size").alias("n_steps"))
    # merge hint: one row per batch, a table that grows with the data
    return ranked.withColumn("batch", batch).join(longest.hint("merge"), F.col("batch") == F.col("__b")).select(
        "__id", "batch", "n_steps")


def pad_sequences(df: DataFrame, id_col: str, col: str, dim: int, batch_rows: int = 256) -> DataFrame:
    """Zero-pad every sequence to the longest of its batch; adds ``batch``.  ``id_col`` is unique.

    Batches are of like length (``length_batches``), so one long row pads its own batch and no other.
    Rows that carry ``batch`` and ``n_steps`` are padded where they are: batches that were dealt from lengths
    alone, before there were vectors, move no vectors.
    """
    zero = F.array_repeat(F.lit(0.0).cast(df.schema[col].dataType.elementType.elementType), dim)
    if not {"batch", "n_steps"} <= set(df.columns):
        df = deal_batches(df, length_batches(df, id_col, col, batch_rows), id_col)
    pad = F.array_repeat(zero, F.col("n_steps") - F.size(col))
    return df.withColumn(col, F.concat(F.col(col), pad)).drop("n_steps")


def deal_batches(df: DataFrame, dealt: DataFrame, id_col: str) -> DataFrame:
    """``df`` with the ``batch`` and ``n_steps`` of its ids."""
    return df.join(dealt.hint("merge"), F.col(id_col).eqNullSafe(F.col("__id"))).drop("__id")


def sequence_with_static(df: DataFrame, seq_col: str, static_cols: Sequence[str]) -> DataFrame:
    """Append the row's static features to every time step."""
    elem = df.schema[seq_col].dataType.elementType.elementType
    static = F.array(*[F.col(c).cast(elem) for c in static_cols])
    return df.withColumn(seq_col, F.transform(seq_col, lambda v: F.concat(v, static)))
