"""Record ids: making them and checking their form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of a UUID. `\z` rather than `$`, which would let a final newline pass.
UUID_FORM = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z"


def random_id() -> Column:
    """A new random id per row; running the job again gives other ids."""
    return F.uuid()


def keyed_id(natural_key: Column) -> Column:
    """An id that depends only on `natural_key`, in the form of a name-based UUID.

    Producing the same source rows twice then writes the same keys, so a rerun
    updates users instead of adding copies of them.
    """
    digest = F.md5(natural_key.cast("string").cast("binary"))

    def part(start: int, length: int) -> Column:
        return F.substring(digest, start, length)

    variant = F.translate(part(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        part(1, 8),
        part(9, 4),
        F.concat(F.lit("3"), part(14, 3)),
        F.concat(variant, part(18, 3)),
        part(21, 12),
    )


def is_uuid(text: Column) -> Column:
    """Whether `text` can be stored as a key; false for NULL."""
    return F.coalesce(text.rlike(UUID_FORM), F.lit(False))


def canonical_id(text: Column) -> Column:
    """Upper and lower case spell the same key; the lower-case form is stored."""
    return F.lower(text)
