"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pactum.llm import (backoff_lm, blocks, decontaminate, jaccard_join, line_dedup, mixing, quality, substring_dedup,
                        url_filter, warc, wrapper)

# Names that the operators use inside.
CLASH = ("id", "k", "z", "n", "t1", "t2", "h1", "h2", "pos", "line", "words", "key", "seg", "cell", "component", "host",
         "path", "rule", "node", "doc", "dropped", "copies", "size", "target", "content", "value", "part", "gone",
         "copy_no", "spans", "links", "first", "last", "bucket", "gram", "total", "chunk", "ranked", "home", "words_", "running",
         "__n_lines", "__n_dropped")
LONG = " ".join(f"word{i}" for i in range(60_000))
PARA = " ".join(f"p{i}" for i in range(60))


def documents(spark):
    rows = [(1, "one two three four five six " * 5, "en", "s", 1), (1, "one two three four five six " * 5, "en", "s", 1),
            (2, None, None, None, None), (3, "", "en", None, 0), (None, PARA, "en", "s", 5), (None, PARA, "en", "s", 5),
            (4, LONG, "en", "t", 9), (5, f"{PARA}\n{PARA}", "de", "t", 9), (6, " \n\t\n ", "en", "", 3),
            (7, PARA + " tail", "en", "s", 1), (8, "short", "en", "s", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"x{c}") for c in CLASH})


def pages(spark):
    rows = [(1, "http://a.net/x", "<p>one</p>"), (1, "http://a.net/x", "<p>one</p>"), (2, None, None), (3, "", ""),
            (None, "http://b.org/fr/", "<p>" + LONG + "</p>"), (4, "no url", "<<<>>><a href='"), (5, "http:///x", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit(f"x{c}") for c in CLASH if c not in ("id",)})


def items(spark):
    return spark.createDataFrame([(1, "one two three four five six one"), (2, None), (None, "shorter"), (1, "p1 p2 p3")],
                                 "item_id long, text string").withColumn("id", F.lit(0))


OPERATORS = {
    "op1": (pages, lambda s, d: url_filter.judge_pages(d)),
    "op2": (pages, lambda s, d: wrapper.main_texts(d)),
    "op3": (documents, lambda s, d: decontaminate.find_items(d, items(s))),
    "op3_drop": (documents, lambda s, d: decontaminate.drop_contaminated(d, items(s))),
    "op4": (documents, lambda s, d: line_dedup.apply_bitmaps(d, line_dedup.line_bitmaps(d))),
    "op5": (documents, lambda s, d: backoff_lm.backoff_scores(d)),
    "op6": (documents, lambda s, d: jaccard_join.jaccard_components(d)),
    "op6_keep": (documents, lambda s, d: jaccard_join.keep_first(d)),
    "op7": (documents, lambda s, d: quality.quality_verdicts(d)),
    "op7_keep": (documents, lambda s, d: quality.keep_good(d)),
    "op8": (documents, lambda s, d: mixing.mix_plan(d)),
    "op8_mix": (documents, lambda s, d: mixing.mix(d)),
    "op9": (pages, lambda s, d: warc.round_trip(d)),
    "op10": (documents, lambda s, d: substring_dedup.remove_repeats(d)),
}
ONE_PER_ROW = {"op1", "op2", "op4", "op5", "op6", "op7", "op8", "op9", "op10"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table_gives_an_empty_result(spark, name):
    make, run = OPERATORS[name]
    assert run(spark, make(spark).limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_rows_do_not_crash(spark, name):
    make, run = OPERATORS[name]
    df = make(spark)
    out = run(spark, df)
    rows = out.collect()
    if name in ONE_PER_ROW:
        assert len(rows) == df.count()
    if name.endswith(("keep", "drop")):
        assert out.columns == df.columns
    if name == "op8_mix":
        assert sorted(out.columns) == sorted(df.columns)  # its copy_no takes the place of the table's
    again = sorted(map(repr, run(spark, df).collect()))
    assert sorted(map(repr, rows)) == again


def test_defined_results(spark):
    docs = documents(spark)
    q = {(r["doc_id"], r["n_words"]): r for r in quality.quality_verdicts(docs).collect()}
    assert q[2, 0]["base_failed"] and not q[2, 0]["kept"] and q[4, 60_000]["kept"] and q[1, 30]["base_failed"]
    lines = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs, min_docs=2)).select(
        "doc_id", "text", "__n_lines", "__n_dropped").collect()
    by_id = {r["doc_id"]: r for r in lines}
    # The null id is one document, smaller than all others; the largest holder keeps its lines.
    assert by_id[5]["text"] == f"{PARA}\n{PARA}" and by_id[5]["__n_dropped"] == 0
    assert by_id[None]["text"] == "" and by_id[None]["__n_dropped"] == 1
    assert by_id[2]["__n_lines"] == 1 and by_id[6]["__n_lines"] == 3 and by_id[1]["__n_dropped"] == 0
    near = {r["id"]: r for r in jaccard_join.jaccard_components(docs).collect()}
    assert near[2]["n_shingles"] == 0 and near[2]["component"] == 2 and near[8]["n_shingles"] == 1
    assert near[7]["component"] == blocks.NULL_ID and near[4]["n_shingles"] == 59_996
    kept = jaccard_join.keep_first(docs)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 3, 4, 6, 8]
    cut = {r["id"]: r for r in substring_dedup.remove_repeats(docs).collect()}
    assert cut[7]["kept"] == "tail" and cut[5]["n_removed"] == 120
    assert cut[blocks.NULL_ID]["n_removed"] == 0 and cut[4]["n_removed"] == 0 and cut[2]["n_words"] == 0
    scores = {r["id"]: r for r in backoff_lm.backoff_scores(docs).collect()}
    assert scores[2]["score"] == 0.0 and scores[2]["n_words"] == 0 and scores[4]["n_words"] == 60_000
    mixed = mixing.mix_plan(docs).collect()
    assert all(0 <= r["__taken_copies"] <= 3 and (r["__size"] or not r["__taken_copies"]) for r in mixed)


def test_line_runs_are_exact(spark):
    shared = [f"this is line number {i} and it is long enough to count as one" for i in range(6)]
    texts = {i: "\n".join([f"own {i}", shared[0], shared[1].upper() + "  ", "", shared[2], f"end {i}", shared[3], ""])
             for i in range(7)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    maps = line_dedup.line_bitmaps(df)
    got = {r["doc"]: [(x["first"], x["last"]) for x in r["dropped"]] for r in maps.collect()}
    assert got == {i: [(1, 2), (4, 4), (6, 6)] for i in range(6)}
    out = {r["doc_id"]: r["text"] for r in line_dedup.apply_bitmaps(df, maps).collect()}
    assert out == {i: (f"own {i}\n\nend {i}\n" if i < 6 else t) for i, t in texts.items()}


def test_boilerplate_is_counted_per_host(spark):
    def doc(i):
        return " ".join(f"d{i}w{j}" for j in range(10))

    site = "the same footer line of this site that stands on all its pages again and again for all who read it here"
    rows = [(i, f"{doc(i)}\n{site}", "h") for i in range(6)] + [(10, f"{doc(10)}\n{site}", "other")]
    rows += [(20 + i, f"{doc(20)}\n{doc(21)}", "copies") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["removed_words"], r["kept"]) for r in
           quality.quality_verdicts(df, max_docs=5, min_left_share=0.4).collect()}
    assert got[0] == (0, True)  # the smallest id that holds the line keeps it
    assert all(got[i] == (len(site.split()), False) for i in range(1, 6))
    assert got[10] == (0, True) and all(got[20 + i] == (0, True) for i in range(6))


def test_mix_meets_its_targets(spark):
    rows = [(i, "w " * (5 + i % 40), f"s{i % 4}" if i % 9 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    plan = mixing.mix_plan(df).collect()
    per = {}
    for r in plan:
        s = per.setdefault(r["__source"], [0, 0, r["source_size"], r["target"]])
        s[0] += r["__size"]
        s[1] += r["__size"] * r["__taken_copies"]
    order = [*sorted(k for k in per if k is not None), None]
    total = sum(s[0] for s in per.values())
    weights = {k: (1, 2, 3)[i % 3] for i, k in enumerate(order)}
    for k, (size, taken, source_size, target) in per.items():
        assert size == source_size and target <= 3 * size + 1e-6 and abs(taken - target) <= 45, k
    assert abs(sum(s[3] for s in per.values()) - total) < 1e-3
    free = [k for k in per if per[k][3] < 3 * per[k][0] - 1e-6]
    assert len({round(per[k][3] / weights[k], 6) for k in free}) == 1
    # Longer classes have higher inclusion odds, up to the cap.
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "text", "source", "copy_no"]
    assert out.count() == sum(r["__taken_copies"] for r in plan)


def test_cut_survives_many_ties(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKETS", 4)
    df = spark.createDataFrame([(i % 7, "a b c", "s") for i in range(300)] + [(9, "x", "t")],
                               "doc_id long, text string, source string")
    plan = mixing.mix_plan(df).collect()
    assert len(plan) == 301 and all(r["__taken_copies"] <= 3 for r in plan)
    same = {}
    for r in plan:
        same.setdefault((r["__id"], r["__source"]), set()).add(r["__taken_copies"])
    # One id of a source at most is cut through, and its copies differ by one.
    split = [k for k, v in same.items() if len(v) > 1]
    assert len({source for _, source in split}) == len(split) and all(max(v) - min(v) <= 1 for v in same.values())
    for source in "st":
        mine = [r for r in plan if r["__source"] == source]
        assert abs(sum(r["__taken_copies"] * r["__size"] for r in mine) - mine[0]["target"]) <= 1.5


def test_stages_keep_the_columns_of_documents(spark):
    df = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "/root/testdata/sf0.001")
        assert out.dtypes == df.dtypes, name
        assert stage(spark, df.limit(0), "/root/testdata/sf0.001").collect() == [], name


def test_rows_without_an_id_are_documents_of_their_own(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(None, a), (11, a), (None, b), (12, b), (None, c), (13, f"{c} x"), (None, f"{a} {b} {c}"), (None, ""), (14, a)]
    rows += [(20, " ".join(f"d{i}" for i in range(60))), (20, " ".join(f"f{i}" for i in range(60)))]
    rows += [(21, rows[-1][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r["id"], r["component_id"]) for r in jaccard_join.jaccard_components(df).collect()), key=repr)
    null = blocks.NULL_ID
    assert got == sorted([(null, 11), (11, 11), (14, 11), (null, 12), (12, 12), (null, 13), (13, 13), (null, None),
                          (null, None), (20, 20), (20, 20), (21, 20)], key=repr)
    kept = sorted(((r["doc_id"], r["text"]) for r in jaccard_join.keep_first(df).collect()), key=repr)
    assert kept == sorted([(None, a), (None, b), (None, c), (None, f"{a} {b} {c}"), (None, ""), rows[9], rows[11]], key=repr)


def test_repeats_go_only_from_the_text_they_were_found_in(spark):
    def words(x, n=100):
        return " ".join(f"{x}{i}" for i in range(n))

    passage = words("p", 70)
    rows = [(1, f"{words('a')} {passage}"), (None, f"{words('b')} {words('c')}"), (None, f"{words('d')} {words('e')}"),
            (2, f"{words('f')} {passage}"), (2, f"{words('g')} {words('h')}"),
            (3, f"{words('c')} tail"), (None, words("q", 40)), (None, f"{words('q', 40)} more")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r["id"], r["kept"], r["n_removed"]) for r in substring_dedup.remove_repeats(df).collect()}
    null = blocks.NULL_ID
    sure = {(1, rows[0][1], 0), (null, rows[1][1], 0), (null, rows[2][1], 0), (2, words("f"), 70), (2, rows[4][1], 0),
            (3, "tail", 100)}
    # Of the two null-id texts with one start the first by fingerprint keeps its words.
    assert got - sure in ({(null, rows[6][1], 0), (null, "more", 40)}, {(null, "", 40), (null, rows[7][1], 0)})
    assert len(got) == len(rows) and sure <= got


def test_mix_takes_only_so_many_of_repeated_rows(spark):
    """Equal rows share a rank; the mix still stops at its target, half a document away at most."""
    same, other = "one two three four five", "x " * 11
    rows = [(1, same, "a")] * 200 + [(None, same, "b")] * 120 + [(7, other, "c")] * 75 + [(i, f"{i} {other}", "c") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    for seed in (1, 2):
        plan = mixing.mix_plan(df, seed=seed).collect()
        assert len(plan) == len(rows)
        per = {}
        for r in plan:
            s = per.setdefault(r["__source"], [0, r["target"], 0])
            s[0] += r["__taken_copies"] * r["__size"]
            s[2] = max(s[2], r["__size"])
        assert all(abs(taken - target) <= longest / 2 + 1e-6 for taken, target, longest in per.values())
        out = mixing.mix(df.withColumn("copy_no", F.lit("own")), seed=seed)
        assert out.columns == ["doc_id", "text", "source", "copy_no"]
        words = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("n")).collect()}
        assert words == {k: v[0] for k, v in per.items()}
