"""Columns to keep may be named like those that an operator uses or returns."""

import pytest

from rollbook.llm import html_layout, language_id, mixing, near_dedup, pii, quality_classifier, quality_rules, secret_scan, substring_dedup

MORE = "n_words, n_shingles, component_id, n_bytes, sha256, spans, n, k, sha, kept, name_, lang_pred, _size, _hash, routed, k0, exact, n_secrets"


@pytest.fixture(scope="module")
def wide(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *(F.lit(c).alias(c) for c in MORE.split(", ")))


def keepers(wide):
    return [c for c in wide.columns if c != "doc_id"]


def checked(found, wide, new):
    """All rows, no column twice, the new columns there, and kept ones with the values they had."""
    assert len({c.lower() for c in found.columns}) == len(found.columns) and set(new) <= set(found.columns)
    rows = found.collect()
    assert len(rows) == wide.count()
    for c in MORE.split(", "):
        if c in found.columns and c not in new:
            assert {r[c] for r in rows} == {c}
    assert set(keepers(wide)) - set(found.columns) <= {"text", *new}


def test_rows_one_by_one(wide):
    keep = ["doc_id", *keepers(wide)]
    empty = secret_scan.Model(secret_scan.Forest([], 0.0), secret_scan.Language.of({}))
    checked(secret_scan.scan(wide, empty, keep), wide, ["n_candidates", "n_secrets", "spans"])
    checked(quality_rules.ledger(wide, keep), wide, ["n_words"])
    checked(pii.find(wide, pii.train(wide), keep), wide, ["exact", "spans"])
    checked(language_id.predict(wide, language_id.Model((), None, ()), keep), wide, ["lang_pred", "score"])
    model = quality_classifier.Model(0, 1, [], 0.5)
    checked(quality_classifier.score(wide, model, keep), wide, ["score"])
    pages = wide.withColumnRenamed("text", "html")
    assert len(html_layout.extract(pages, [c for c in keep if c != "text"]).collect()) == wide.count()


def test_groups(wide):
    checked(near_dedup.groups(wide, keepers(wide)), wide, ["n_shingles", "component_id"])
    checked(near_dedup.groups(wide, keepers(wide), group="root"), wide, ["n_shingles", "component_id", "root"])


def test_substrings(wide):
    keep = ["doc_id", *keepers(wide)]
    base, kept = substring_dedup.find(wide, keep)
    checked(base, wide, ["name", "n_bytes", "sha256", "copies"])
    rows = substring_dedup.digest(base, kept, keep)
    assert rows.count() == wide.count() and len(set(rows.columns)) == len(rows.columns)
    plain = substring_dedup.digest(*substring_dedup.find(wide, ["doc_id"]), ["doc_id"]).collect()
    of = lambda rows: sorted(repr((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in rows)
    assert of(rows.collect()) == of(plain)


def test_mix(wide):
    from pyspark.sql import functions as F

    rows = wide.withColumn("members_of", F.array(mixing.source_key(F.col("source")))).withColumn("words", mixing.size_of(F.col("text")))
    found = mixing.mix(rows, "members_of", "words", "doc_id", mixing.cyclic_weights, ["doc_id", *keepers(wide)])
    checked(found, wide, ["copies", "taken", "routed"])
