"""The stages of the pipeline one after the other against plain Python, with planted rows; nulls, empty tables and clashing columns."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from agrispark.llm import quality, queries, secrets

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def smallest_of_groups(rows):
    """(id, text) rows that stay when each group linked by Jaccard >= 0.8 keeps its smallest id (nulls last)."""
    sets = [shingles(t) for _, t in rows]
    where = {}
    for k, s in enumerate(sets):
        for x in s:
            where.setdefault(x, set()).add(k)
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for k, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j < k}:
            if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                group[root(k)] = root(j)
    held = {}
    for k, r in enumerate(rows):
        held.setdefault(root(k), []).append(r)
    return sorted(min(own, key=lambda r: (r[0] is None, r[0] or 0)) for own in held.values())


def clean(k):
    return f"Paragraph {k} tells of " + " ".join(f"matter{k}x{j}" for j in range(40)) + "."


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage makes of the smallest tables and planted rows."""
    folder = str(tmp_path_factory.mktemp("tables"))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.length("text").desc()).first()["text"]
    planted = [(10**6 + k, clean(k)) for k in range(6)]
    planted += [(10**6 + 10, clean(0)), (10**6 + 11, clean(1) + " tail"), (10**6 + 12, None), (10**6 + 13, ""), (10**6 + 14, f"{clean(20)} {item} {clean(21)}"), (10**6 + 15, f"{clean(22)} password=Tr0ub4dor&3x9Qz {clean(23)}")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(spark.createDataFrame([(i, t, "en", "planted", None if t is None else len(t)) for i, t in planted], SCHEMA))
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    now, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    with pytest.MonkeyPatch.context() as patch:
        # planted rows are not like the labelled ones, so the classifier's judgement of them is fixed
        judge = quality.quality_stage
        patch.setattr(corpus_pipeline, "STAGES", [("quality", lambda s, d, f: judge(s, d.where("source <> 'planted' or source is null"), f).unionByName(d.where("source = 'planted'"))), *corpus_pipeline.STAGES[1:]])
        out["start"] = now.collect()
        for name, stage in corpus_pipeline.STAGES:
            path = f"{folder}/{name}"
            stage(spark, now, folder).write.parquet(path)
            now = spark.read.parquet(path)
            out[name] = now.collect()
            if name == "secrets":
                out["folder"] = path
    return out


def pairs(rows):
    return sorted(((r.doc_id, r.text) for r in rows), key=str)


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "secrets", "mix"]
    for name in ("quality", "near_duplicates", "decontaminate", "secrets"):
        assert set(stages[name][0].asDict()) == set(stages["start"][0].asDict())
    ids = [len(stages[n]) for n in ("start", "quality", "near_duplicates", "decontaminate")]
    assert ids[0] >= ids[1] > ids[2] > ids[3] > 0


def test_one_of_each_group_stays(stages):
    assert pairs(stages["near_duplicates"]) == sorted(smallest_of_groups([(r.doc_id, r.text) for r in stages["quality"]]), key=str)


def test_leaks_go_and_clean_rows_stay(stages):
    kept = {r.doc_id for r in stages["decontaminate"]}
    assert 10**6 + 14 not in kept and {10**6 + k for k in (0, 1, 2, 3, 4, 5, 15)} <= kept
    gone = [r for r in stages["near_duplicates"] if r.doc_id not in kept]
    assert pairs(r for r in stages["near_duplicates"] if r.doc_id in kept) == pairs(stages["decontaminate"])
    assert len(gone) < len(stages["near_duplicates"]) / 2


def test_secrets_are_replaced(stages):
    before, after = {r.doc_id: r for r in stages["decontaminate"]}, {r.doc_id: r for r in stages["secrets"]}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.text == (None if before[i].text is None else secrets.redact_text(before[i].text))
        assert r.text is None or r.n_chars == len(r.text)
    assert "Tr0ub4dor" not in after[10**6 + 15].text and after[10**6 + 15].text.startswith(clean(22))


def test_mix_equals_its_sql(stages):
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{stages['folder']}/*.parquet'")
    assert sorted(c.sql(queries.ORACLE_SQL["op10_mix_sources"]).fetchall()) == sorted(map(tuple, stages["mix"]))


@pytest.mark.parametrize("kind", ["empty", "nulls"])
def test_empty_and_null_tables(spark, tmp_path, kind):
    rows = [] if kind == "empty" else [(None, None, None, None, None)] * 3 + [(1, None, "en", None, None), (None, clean(1), None, "s", 10), (2, clean(2), "en", "s", 11)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "'x' as row", "2 as key", "3 as component_id")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    (labels if kind == "nulls" else labels.where("false")).write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) == 0 if kind == "empty" else len(out) <= len(rows)
