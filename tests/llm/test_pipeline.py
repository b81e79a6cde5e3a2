import pytest

import corpus_pipeline as cp


@pytest.fixture(scope="module")
def folder(spark, odd, tmp_path_factory):
    """A folder of tables like the given ones, with odd rows and further columns."""
    path = str(tmp_path_factory.mktemp("tables"))
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = odd.unionByName(given.selectExpr("doc_id + 1000 AS doc_id", "text", "lang", "source", "n_chars"), allowMissingColumns=True)
    more.write.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    labels.selectExpr("doc_id + 1000 AS doc_id", "quality", "toxic").write.parquet(f"{path}/labels.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    more.limit(0).write.parquet(f"{path}/none.parquet")
    return path


def test_stages_are_the_asked_ones():
    assert [n for n, _ in cp.STAGES] == [
        "quality classifier", "minhash near-dedup", "benchmark decontamination", "secret scan", "mixing to target weights",
    ]


@pytest.mark.parametrize("stage", [f for _, f in cp.STAGES[:4]])
def test_stage_keeps_columns_and_bears_empty_tables(spark, folder, stage):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert stage(spark, docs, folder).columns == docs.columns
    assert stage(spark, spark.read.parquet(f"{folder}/none.parquet"), folder).count() == 0


def test_one_of_each_group_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 1000 or doc_id is null")
    left = sorted(repr((r.doc_id, (r.text or "")[:14])) for r in cp.near_duplicates(spark, docs, folder).collect())
    want = [(1, ""), (2, ""), (3, " \n\t "), (4, "word"), (5, "one two three "), (7, "pass0 pass1 pa"), (10, "w0x0 w1x1 w2x2"),
            (12, "|" * 14), (13, "ä ö ü ß ä ö ü "), (14, "a" * 14), (None, "pass0 pass1 pa"), (None, ""),
            (15, "mail me a@b.co"), (5, "another text"), (16, 'token = "9233a')]
    assert left == sorted(map(repr, want))


def test_whole_pipeline(spark, folder):
    out = cp.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert out.columns == [c for c in docs.columns if c not in ("copies", "taken")] + ["copies", "taken"]
    rows = out.collect()
    assert rows and all(1 <= r.copies <= 3 for r in rows)
    # Stage by stage on the whole tables, as plain versions judge them.
    from test_decontamination import plain

    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert not any(plain(r.text, items)[1] for r in rows[:40])
    assert [(r.doc_id, r.text) for r in rows if "AKIASJDZ" in (r.text or "")] == []


def test_pipeline_repeats(spark):
    sf = "/root/testdata/sf0.001"
    one, two = (sorted(map(repr, cp.run(spark, sf).collect())) for _ in range(2))
    assert one == two


def test_one_stays_where_different_near_copies_share_the_least_id(spark, folder):
    passage = " ".join(f"pass{i}" for i in range(90))
    rows = [(1, passage), (1, passage + " tail"), (1, passage + " end"), (2, passage + " other"), (3, "alone " * 3), (1, "not alike at all, this one")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = [(r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, folder).collect()]
    assert sum(t.startswith("pass0") for _, t in left) == 1
    assert {(3, "alone " * 3), (1, "not alike at all, this one")} < set(left) and len(left) == 3


def test_stages_against_plain_versions_over_all_rows(spark, folder):
    """What each stage keeps of all rows of its input, against a plain version on the driver."""
    from test_decontamination import plain as hits
    from test_near_dedup import plain as groups

    from rollbook.llm import quality_classifier, secret_scan
    from rollbook.llm.common import table

    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = {r.doc_id: r.text for r in docs.collect()}
    name = lambda frame: {r.doc_id: r.text for r in frame.collect()}

    model = quality_classifier.train(docs, table(spark, folder, "labels"))
    scores = {i: float(model.score(quality_classifier.features((t or "").encode())[None].astype(float))[0]) for i, t in rows.items()}
    assert set(name(cp.quality(spark, docs, folder))) == {i for i, s in scores.items() if s >= cp.KEPT_FROM}

    judged = [eval(x) for x in groups(list(rows.items()))]  # (doc_id, shingles, component)
    assert set(name(cp.near_duplicates(spark, docs, folder))) == {i for i, n, c in judged if not n or i == c}

    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    found = set(name(cp.decontaminate(spark, docs, folder)))
    assert found == {i for i, t in rows.items() if not hits(t, items)[1]}

    scan = secret_scan.train(docs)
    for i, text in name(cp.secrets(spark, docs, folder)).items():
        raw, out, at = (rows[i] or "").encode(), b"", 0
        for start, end in scan.find(raw)[1]:
            out, at = out + raw[at:start] + b"[SECRET]", end
        assert (text or "") == (out + raw[at:]).decode()


def test_mix_over_all_rows_and_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = cp.mix(spark, docs, folder)
    assert mixed.columns == [c for c in docs.columns if c not in ("copies", "taken")] + ["copies", "taken"]
    words = lambda t: len([w for w in (t or "").split() if w])
    given = [(r.source, words(r.text)) for r in docs.collect()]
    sizes = {s: sum(n for k, n in given if k == s) for s, _ in given}
    taken = {}
    for r in mixed.collect():
        assert 1 <= r.copies <= 3 and r.taken <= 3 * words(r.text)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(taken.get(s, 0) <= 3 * n for s, n in sizes.items())
    longest = {s: max(n for k, n in given if k == s) for s in sizes}  # documents are drawn whole
    assert abs(sum(taken.values()) - sum(sizes.values())) <= sum(longest.values()) / 2
    empty = cp.mix(spark, spark.read.parquet(f"{folder}/none.parquet"), folder)
    assert empty.count() == 0 and empty.columns == mixed.columns
