"""The corpus pipeline as a whole and stage by stage, against plain versions, with empty, unlabelled and clashing tables."""

import random

import pytest
from pyspark.sql import functions as F
from test_operators import plain_components, plain_hits, plain_lines, words

import corpus_pipeline
from pagelake.llm import toxicity

#: Names that stages could use inside, with values that must come through.
CLASHES = {"__id": "c1", "__kept": "c2", "n_lines": "777", "n_removed": "888", "text_before": "c3", "evidence": "c4", "row": "c5", "flags": "c6",
           "_spans": "c7", "_items": "c8", "_words": "c9", "component_id": "c10", "keep": "c11", "score": "c12"}


def corpus():
    rng = random.Random(21)
    item = " ".join(words(16, 900))
    rows = []
    for i in range(160):
        body = [" ".join(words(rng.randint(6, 14), 5000 + i * 9 + k)) for k in range(rng.randint(2, 5))]
        if i % 5 == 0:
            body.insert(1, "All rights reserved.")
        if i % 10 == 3:
            body[0] += " vile rotten foul"
        if i % 17 == 5:
            body.append(f"{item} and a few words of its own")
        rows.append((i, "\n".join(body), f"s{i % 12}"))
    for k in range(6):  # near copies of one text
        base = rows[8][1].split(" ")
        base[-1 - k] = f"other{k}"
        rows.append((200 + k, " ".join(base), "s1"))
    rows += [(300, None, "s2"), (301, "", None), (302, "\n\n", "s3"), (303, item, "s4"), (304, rows[9][1], "s9"), (304, rows[9][1], "s9"), (None, "no identifier here", "s5")]
    labels = [(i, 1, int(i % 10 == 3)) for i in range(160)]
    return rows, labels, [(1, item), (2, None)]


def write(spark, folder, rows, labels, items):
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.withColumns({k: F.lit(v) for k, v in CLASHES.items()}).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def as_rows(df):
    return sorted(((r["doc_id"], r["text"], r["source"]) for r in df.collect()), key=repr)


def test_every_stage_does_its_work_and_keeps_columns(spark, tmp_path):
    rows, labels, items = corpus()
    docs = write(spark, tmp_path, rows, labels, items)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_join", "decontamination", "mixing"]
    stages = dict(corpus_pipeline.STAGES)

    def step(name, before):
        after = corpus_pipeline.stored(stages[name](spark, before, str(tmp_path)))
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
        assert after.filter(~F.lit(True) | sum((F.col(f"`{k}`") != v).cast("int") for k, v in CLASHES.items()).cast("boolean")).count() == 0
        return after

    clean = step("toxicity", docs)
    scored = {(r["doc_id"], r["score"] >= 0.3) for r in toxicity.score(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    gone = {i for i, bad in scored if bad}
    assert as_rows(clean) == sorted((r for r in rows if r[0] not in gone), key=repr)
    assert len({i for i in range(160) if i % 10 == 3} - gone) <= 2 and len(gone - {i for i in range(160) if i % 10 == 3}) <= 2

    before = as_rows(clean)
    lines = step("line_dedup", clean)
    assert sorted(((i, t) for i, t, _ in as_rows(lines)), key=repr) == sorted(((r[0], r[3]) for r in plain_lines(before, 10, 1)), key=repr)
    assert lines.filter("text is not null and n_chars <> length(text)").count() == 0 and lines.filter("text like '%All rights%'").count() == 1

    before = as_rows(lines)
    apart = step("ngram_join", lines)
    keep = [(r, c) for r, (_, _, c) in zip(sorted(before, key=repr), sorted(plain_components(before), key=repr), strict=True)]
    assert {r[0] for r in as_rows(apart)} == {r[0] for r, c in keep if r[0] == c or c is None}
    assert not {201, 202, 203} & {r[0] for r in as_rows(apart)}

    before = as_rows(apart)
    hits = {r[0]: (r[1], r[2]) for r in plain_hits(before, items, 10)}
    free = step("decontamination", apart)
    assert {r[0] for r in as_rows(free)} == {r[0] for r in before if 2 * hits[r[0]][1] <= hits[r[0]][0]} and 303 not in {r[0] for r in as_rows(free)}
    assert not any("_".join(items[0][1].split()[:10]) in "_".join((t or "").split()) for _, t, _ in as_rows(free))

    plan = stages["mixing"](spark, free, str(tmp_path)).collect()
    assert sorted((r["doc_id"] for r in plan), key=repr) == sorted((r[0] for r in as_rows(free)), key=repr)
    total = sum(r["size"] for r in plan)
    assert abs(sum(r["taken"] for r in plan) - 1.5 * total) < 60 and all(r["taken"] <= 2 * r["size"] for r in plan)

    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, plan))


@pytest.mark.parametrize("what", ["documents", "labels", "benchmark", "few labels"])
def test_empty_tables(spark, tmp_path, what):
    rows, labels, items = corpus()
    rows, labels, items = rows[:40], labels[:40], items
    if what == "documents":
        rows = []
    elif what == "benchmark":
        items = []
    else:
        labels = labels[:4] if what == "few labels" else []
    docs = write(spark, tmp_path, rows, labels, items)
    got = corpus_pipeline.run(spark, str(tmp_path))
    if what == "documents":
        assert got.count() == 0
    elif what == "benchmark":
        assert docs.count() - 8 < got.count() <= docs.count()
    else:
        # Without a fitted model the first stage keeps every document.
        assert dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, str(tmp_path)).count() == docs.count() and got.count() > 30
