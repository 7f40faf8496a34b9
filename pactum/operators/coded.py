"""Word counts and lookups over texts by dictionary-coded blocks.

Documents are dealt into blocks of a few MB of text by a hash.  The distinct
words of a block meet the dictionary once, as (block, word) rows, so a word
that fills half the corpus crosses the network once per block and not once per
token.  A block's documents and its part of the dictionary then meet in one
task, where Arrow splits the texts, looks the words up and puts the values at
the words' places.  Tokens never become rows, and nothing is regrouped by
document: a text crosses the network once, as a whole.

A dictionary of at most 64 MB (checked) goes to every task instead, and texts
are coded where they are read, without a shuffle.

Vectors are coded first and looked up last: a word leaves Python as its number,
and a table of vectors of at most 64 MB (checked) joins the plan as one array.
A larger one travels with the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType

from pactum.operators.indexing import dense_index
from pactum.session import durable

BLOCK_BYTES = 4 << 20
SMALL_TABLE_BYTES = 64 << 20
VECTOR_TABLE_BYTES = 64 << 20
# texts coded at once: so many, or so many bytes of them; each time the dictionary is hashed anew
ROWS, TEXT_BYTES = 10_000, 8 << 20


def split_tokens(texts: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """(tokens, offsets): the single-space split of every text, null texts as no token."""
    whole = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    lists = pc.split_pattern(whole.cast(pa.string()), " ")
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return pc.list_flatten(lists), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


HELD_ROWS = 300  # texts whose distinct words are told apart at once


def count_words(df: DataFrame, text_col: str, counted: Column | None = None, held: str | None = None) -> DataFrame:
    """(word, n) of the single-space split of every text; with ``held`` also the number of rows that hold the word.

    With ``counted`` n is of the rows where it is true, and 0 for the words of the others alone.  Words are counted where
    they are read, a batch of texts at a time: what is shuffled is a batch's distinct words.
    """
    some = counted is not None

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, offsets = split_tokens(b.column(0))
            coded = tokens.dictionary_encode()
            words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
            sizes = np.diff(offsets)
            mine = code[np.repeat(b.column(1).to_numpy(zero_copy_only=False), sizes)] if some else code
            made = [words, pa.array(np.bincount(mine, minlength=len(words)))]
            if held:
                rows, row = np.zeros(len(words), np.int64), np.repeat(np.arange(b.num_rows), sizes)
                for i in range(0, b.num_rows, HELD_ROWS):
                    part = slice(offsets[i], offsets[min(i + HELD_ROWS, b.num_rows)])
                    pairs = pc.unique(pa.array(code[part].astype(np.int64) * HELD_ROWS + row[part] - i))
                    rows += np.bincount(pairs.to_numpy() // HELD_ROWS, minlength=len(words))
                made.append(pa.array(rows))
            yield pa.RecordBatch.from_arrays(made, names)

    names = ["word", "n", *([held] if held else [])]
    source = df.select(F.col(text_col).cast("string"), *([F.coalesce(counted, F.lit(False)).alias("__counted")] if some else []))
    each = source.mapInArrow(counts, ", ".join(["word string", *(f"`{c}` long" for c in names[1:])]))
    return each.groupBy("word").agg(*[F.sum(c).alias(c) for c in names[1:]])


def _known_values(left: pa.Table, right: pa.Table, text_col: str) -> pa.Array:
    """Per text the values of its known words, in order."""
    tokens, offsets = split_tokens(left.column(text_col))
    at = pc.index_in(tokens, value_set=right.column("__word").combine_chunks().cast(pa.string()))
    known = at.is_valid().to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(known, dtype=np.int64)])[offsets]
    values = right.column("__value").combine_chunks().take(at.drop_null())
    return pa.ListArray.from_arrays(pa.array(kept, pa.int32()), values)


def _replaced_words(left: pa.Table, right: pa.Table, text_col: str) -> pa.Array:
    """Per text its words, those of the dictionary replaced, joined by single spaces."""
    tokens, offsets = split_tokens(left.column(text_col))
    at = pc.index_in(tokens, value_set=right.column("__word").combine_chunks().cast(pa.string()))
    other = right.column("__value").combine_chunks().cast(pa.string()).take(at)
    words = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pc.if_else(at.is_valid(), other, tokens))
    return pc.binary_join(words, " ")


def _slices(batch: pa.RecordBatch, text_col: str) -> Iterator[pa.RecordBatch]:
    """Rows in order, ``ROWS`` or about ``TEXT_BYTES`` of text at a time (a longer text stands alone)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[at] - sizes[at] + TEXT_BYTES, "right"))
        stop = min(max(stop, at + 1), at + ROWS)
        yield batch.slice(at, stop - at)
        at = stop


def table_bytes(df: DataFrame, *cols: str) -> int:
    """About how many bytes the columns' values take."""
    kinds = {c: df.schema[c].dataType for c in cols}
    width = {c: 4 if isinstance(k, ArrayType) and isinstance(k.elementType, FloatType) else 8 for c, k in kinds.items()}
    each = [F.coalesce(F.size(c) * width[c], F.lit(0)) if isinstance(kinds[c], ArrayType)
            else F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in cols]
    return df.agg(F.coalesce(F.sum(reduce(add, each) + 16), F.lit(0))).first()[0]


def lookup(df: DataFrame, text_col: str, dictionary: DataFrame, word_col: str, value_col: str, out: str,
           replace: bool = False, small_bytes: int | None = None) -> DataFrame:
    """``df`` (its columns but the text, then ``out``): values of each text's known words, or the text with words replaced.

    ``dictionary`` holds a word once; up to ``small_bytes`` it goes to every task.  Nulls and texts without a known word give
    an empty array (a null text with ``replace``: the empty string).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    entries = dictionary.select(F.col(word_col).alias("__word"), F.col(value_col).alias("__value"))
    keep = [f for f in df.schema.fields if f.name != text_col]
    made_type = StringType() if replace else ArrayType(dictionary.schema[value_col].dataType)
    schema = StructType([*keep, StructField(out, made_type)])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        made = (_replaced_words if replace else _known_values)(left, right, text_col)
        return pa.table([*[left.column(f.name) for f in keep], made], names=[*[f.name for f in keep], out])

    if table_bytes(entries, "__word", "__value") <= (SMALL_TABLE_BYTES if small_bytes is None else small_bytes):
        small = entries.toArrow()

        def everywhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for part in _slices(b, text_col):
                    yield from run(pa.Table.from_batches([part]), small).combine_chunks().to_batches()

        return df.withColumn(text_col, text).mapInArrow(everywhere, schema)
    total = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    block = F.pmod(F.xxhash64(*df.columns), F.lit(max(1, total // BLOCK_BYTES)))
    docs = df.withColumns({text_col: text, "__block": block})
    words = docs.select("__block", F.explode(F.array_distinct(F.split(F.col(text_col), " ", -1))).alias("__word")).distinct()
    # merge hint: the planner's estimate of an exploded stream is far too small, and would broadcast it
    parts = words.hint("merge").join(entries, "__word").select(F.col("__block").alias("__b"), "__word", "__value")
    return docs.groupBy("__block").cogroup(parts.groupBy("__b")).applyInArrow(run, schema)


def lookup_vectors(df: DataFrame, text_col: str, dictionary: DataFrame, word_col: str, vec_col: str, out: str) -> DataFrame:
    """``df`` (its columns but the text, then ``out``): the vectors of each text's known words, in order."""
    if table_bytes(dictionary, word_col, vec_col) > VECTOR_TABLE_BYTES:
        return lookup(df, text_col, dictionary, word_col, vec_col, out, small_bytes=-1)
    coded = dense_index(dictionary.select(F.col(word_col).alias("__w"), F.col(vec_col).alias("__v")), ["__w"], out="__code")
    coded = coded.select("__w", F.col("__code").cast("int").alias("__code"), "__v")
    whole = coded.agg(F.transform(F.array_sort(F.collect_list(F.struct("__code", "__v"))), lambda s: s["__v"]).alias("__table"))
    table = durable(whole, "vector-table").scalar()
    numbers = lookup(df, text_col, coded.select("__w", "__code"), "__w", "__code", "__codes", small_bytes=VECTOR_TABLE_BYTES)
    return numbers.withColumn("__table", table).select(
        *[F.col(c) for c in df.columns if c != text_col], F.transform("__codes", lambda c: F.get(F.col("__table"), c)).alias(out))
