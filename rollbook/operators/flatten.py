"""Raw user document to the flat record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.fixed import CONTAINERS, DOCUMENT, USER_COLUMNS
from rollbook.functions.documents import plain, printed
from rollbook.operators.once import with_once


def _reason(user: Column, document: Column) -> Column:
    """Why a document cannot be flattened, NULL when it can."""
    reason = F.when(document.isNull(), F.lit("document is not an object"))
    for path in CONTAINERS:
        container = document
        for name in path.split("."):
            container = container[name]
        present = F.try_variant_get(user, f"$.{path}", "variant").isNotNull()
        reason = reason.when(container.isNull() & present, F.lit(f"{path} is not an object"))
    return reason


#: Leaves of a document whose text stands alone, and those that stand in a sentence.
_PLAIN = ("gender", "email", "login.username", "dob.date", "registered.date", "phone", "picture.medium")
_PRINTED = (
    "name.first",
    "name.last",
    *(f"location.{part}" for part in ("street.number", "street.name", "city", "state", "country", "postcode")),
)


def _leaf(document: Column, path: str) -> Column:
    for name in path.split("."):
        document = document[name]
    return document


def _texts(document: Column) -> Column:
    """The texts of all leaves, by kind and place.

    Each kind is one lambda over an array of its leaves. Written out per leaf, the same expressions make a method
    that takes seconds to compile and is then too large to be used.
    """
    kinds = {"plain": (_PLAIN, plain), "printed": (_PRINTED, printed)}
    return F.struct(
        *(F.transform(F.array(*(_leaf(document, path) for path in paths)), text).alias(kind) for kind, (paths, text) in kinds.items())
    )


def _record(texts: Column) -> dict[str, Column]:
    """The columns of the flat record except its id."""
    plain = {path: F.get(texts["plain"], F.lit(i)) for i, path in enumerate(_PLAIN)}
    printed = {path: F.get(texts["printed"], F.lit(i)) for i, path in enumerate(_PRINTED)}
    address = [printed[f"location.{part}"] for part in ("street.name", "city", "state", "country")]
    comma = [x for part in address for x in (part, F.lit(", "))][:-1]
    return {
        "full_name": F.concat(printed["name.first"], F.lit(" "), printed["name.last"]),
        "gender": plain["gender"],
        "address": F.concat(printed["location.street.number"], F.lit(" "), *comma),
        "postcode": printed["location.postcode"],
        "email": plain["email"],
        "user_name": plain["login.username"],
        "dob": plain["dob.date"],
        "registered_date": plain["registered.date"],
        "phone": plain["phone"],
        "image": plain["picture.medium"],
    }


def flatten(documents: DataFrame) -> DataFrame:
    """`documents` with the record of each `user`, or the `reason` why it has none."""
    parts = with_once(documents, "_document", F.try_variant_get("user", "$", DOCUMENT))
    parts = with_once(parts, "_texts", _texts(F.col("_document")))
    columns = _record(F.col("_texts"))
    return parts.withColumns(
        {"reason": _reason(F.col("user"), F.col("_document"))}
        | {name: columns[name] for name in USER_COLUMNS if name != "id"}
    ).drop("_document", "_texts")


def flatten_users(documents: DataFrame, record_id: Column, *keep: str) -> DataFrame:
    """Flat records of the documents in `user` that can be flattened, after the `keep` columns."""
    return (
        flatten(documents)
        .filter(F.col("reason").isNull())
        .select(*keep, record_id.alias("id"), *USER_COLUMNS[1:])
    )


def flatten_rejects(documents: DataFrame, *keep: str) -> DataFrame:
    """The documents that cannot be flattened, each with its reason and its JSON text."""
    return (
        flatten(documents)
        .filter(F.col("reason").isNotNull())
        .select(*keep, "reason", F.to_json("user").alias("document"))
    )
