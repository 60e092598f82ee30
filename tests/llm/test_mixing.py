from collections import defaultdict

from shiftledger.llm.mixing import mix_decisions, mix_documents


def test_targets_and_taken_words(spark, sf_dir):
    rows = mix_decisions(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    size, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
        assert r.taken <= 2 * r["size"] and r.taken % max(1, r["size"]) == 0
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6 * sum(size.values())
    for source in size:
        assert target[source] <= 2 * size[source] + 1e-9
        assert abs(taken[source] - target[source]) <= max(0.05 * target[source], largest[source] / 2)
    # open sources share by weight
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
    levels = {round(target[s] / weight[s], 6) for s in size if target[s] < 2 * size[s] - 1e-6}
    assert len(levels) == 1


def test_reruns_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = sorted(map(tuple, mix_decisions(docs).collect()))
    assert first == sorted(map(tuple, mix_decisions(docs.repartition(7)).collect()))


def test_longer_documents_are_likelier(spark):
    rows = [(i, "w " * (4 if i % 2 else 400), "s") for i in range(4000)] + [(-1, "w " * 400_000, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = mix_decisions(docs, weights=(1, 5)).where("source = 's'").groupBy("size").avg("copies").collect()
    by_size = {r["size"]: r["avg(copies)"] for r in copies}
    # 3 against 9 binary digits
    assert 0 < by_size[4] < by_size[400] <= 2


def test_odd_rows(spark, odd_docs, no_docs):
    rows = mix_decisions(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r["size"] for r in rows if r.doc_id in (3, 4, 5)} == {0}
    mixed = mix_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert mix_decisions(no_docs).count() == 0 and mix_documents(no_docs).count() == 0


def test_runs_no_python(spark, sf_dir):
    plan = mix_decisions(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
