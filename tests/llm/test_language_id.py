import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from rollbook.llm import language_id
from rollbook.llm.queries import op13_language_id

SYLLABLES = {
    "aa": "ka ti ro men da lo".split(), "ab": "ka ti ro men da su".split(),
    "xx": "schw ing fjord qual tz".split(), "xy": "schw ing fjord qual øv".split(),
}


def documents(spark, size=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for lang, syllables in SYLLABLES.items():
        for _ in range(size):
            words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 80))]
            rows.append((len(rows), " ".join(words).title() + " 123 !", lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_families_first(spark):
    rows = documents(spark)
    model = language_id.train(rows, F.col("doc_id") % 3 != 1)
    assert sorted(model.families) == [("aa", "ab"), ("xx", "xy")]
    # One machine between the families, one within each: not one per pair of languages.
    assert len(model.root.pairs) == 1 and [len(n.pairs) for n in model.within] == [1, 1]
    found = language_id.predict(rows, model, ["doc_id", "lang"]).where("doc_id % 3 = 1")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()
    assert found.where("score < 0 or score > 1").count() == 0
    again = language_id.train(rows.repartition(5), F.col("doc_id") % 3 != 1)
    assert all((a.weights == b.weights).all() for a, b in zip((model.root, *model.within), (again.root, *again.within), strict=True))


def test_held_out_accuracy_of_the_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    found = op13_language_id(spark, sf)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    known = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    rows = found.join(known, "doc_id").collect()
    assert len(rows) == known.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and language_id.has_letter(r.text or "")]
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.97


def test_machine_separates_and_keeps_the_margin():
    rng = np.random.default_rng(0)
    vectors, sides = [], []
    for i in range(80):
        side = 1 if i % 4 else -1  # classes of different size
        place = np.sort(rng.choice(100, 20, replace=False)) + (0 if side > 0 else 60)
        vectors.append((place.astype(np.int32), np.full(20, 1 / np.sqrt(20))))
        sides.append(side)
    w = language_id.machine(vectors, np.array(sides))
    margins = [s * (w[p] @ v + w[-1]) for (p, v), s in zip(vectors, sides, strict=True)]
    assert min(margins) > 0.9


def test_features():
    x = language_id.features("Ärger, 12 ärger")
    assert x.shape == (language_id.WIDTH,) and abs(float(x @ x) - 1) < 1e-5
    assert (language_id.features("a  b!!") == language_id.features("A b")).all()
    long = "abc dé " * 50
    whole, block = language_id.features(long), language_id._BLOCK
    try:
        language_id._BLOCK = 7
        assert (language_id.features(long) == whole).all()
    finally:
        language_id._BLOCK = block


def test_odd_rows_and_empty_tables(spark, odd, none):
    keep = [c for c in odd.columns if c not in ("score",)]
    model = language_id.train(odd, F.lit(True))
    found = language_id.predict(odd, model, keep).collect()
    assert len(found) == odd.count()
    assert {(r.lang_pred, r.score) for r in found if not language_id.has_letter(r.text or "")} == {("und", 0.0)}
    assert {(r.lang_pred, r.score) for r in found if language_id.has_letter(r.text or "")} == {("en", 1.0)}
    nothing = language_id.train(none, F.lit(True))
    assert {r.lang_pred for r in language_id.predict(odd, nothing, ["doc_id"]).collect()} == {"und"}
    assert language_id.predict(none, model, ["doc_id"]).count() == 0
    unlabelled = language_id.train(odd.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert unlabelled.root is None


def test_learns_a_bounded_number_of_different_texts(spark):
    rows = documents(spark, 30)
    copies = rows.crossJoin(spark.range(20).select("id")).drop("id")
    seen = []
    model = language_id.train(copies, F.lit(True), per_class=10)
    plain = language_id.train(rows, F.lit(True), per_class=10)
    seen += [model.families, plain.families]
    assert seen[0] == seen[1] and len(model.families) == 2
