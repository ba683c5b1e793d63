"""Every stage of the pipeline, and the chain, on NULL and repeated ids, NULL, empty and long
texts, extra columns with clashing names, and an empty table."""

import pytest

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, sha string, fingerprint string, kept boolean, score double"


def rows(spark):
    base = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    extra = (7, "x", "y", True, 0.5)
    out = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], *extra) for r in base]
    good = out[1][1]
    out += [(None, good, "en", "s", 1, *extra), (None, None, None, None, None, None, None, None, None, None), (out[3][0], out[4][1], "en", "s", 1, *extra),
            (out[3][0], out[3][1], "en", "s", 1, *extra), (90001, None, "en", "s", 0, *extra), (90002, "", "en", "s", 0, *extra),
            (90003, " \t\n ", "en", "s", 0, *extra), (90004, good * 200, "en", "s", 1, *extra)]
    return out


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    made = {}
    for name, docs in (("full", rows(spark)), ("empty", [])):
        made[name] = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame(docs, DOCS).write.parquet(f"{made[name]}/documents.parquet")
        labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
        labels.write.parquet(f"{made[name]}/labels.parquet")
    return made


@pytest.mark.parametrize("folder", ["full", "empty"])
@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_each_stage(spark, folders, folder, stage):
    name, run = stage
    docs = spark.read.parquet(f"{folders[folder]}/documents.parquet")
    out = run(spark, docs, folders[folder])
    got = out.collect()
    if folder == "empty":
        assert got == []
    elif name != "packing":
        assert out.columns == docs.columns and 0 < len(got) <= docs.count()
        assert all(r["score"] in (0.5, None) for r in got)  # a caller's column is carried, not ours
    else:
        assert {r["doc_id"] for r in got} == {r["doc_id"] for r in docs.collect()}


@pytest.mark.parametrize("folder", ["full", "empty"])
def test_the_chain(spark, folders, folder):
    got = corpus_pipeline.run(spark, folders[folder]).collect()
    assert (got == []) == (folder == "empty")
    if got:
        offsets = {}
        for r in got:
            offsets.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for pieces in offsets.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
