"""What batch file names, dataset names and stored host text say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT = r"[+-]?[0-9]+"


def batch_identity(file_name: Column) -> Column:
    """``b<id>_<count>.txt`` as struct(batch_no, declared_count).

    The id lies between the first ``b`` and the last ``_``, the count between that
    ``_`` and the last ``.``. A part that is no integer is 0, and without an id the
    count is not read either.
    """
    with_b = F.regexp_extract(file_name, rf"^[^b]*b({_INT})_[^_]*\z", 1)
    without_b = F.regexp_extract(file_name, rf"^({_INT})_[^_]*\z", 1)
    number = F.when(file_name.contains("b"), with_b).otherwise(without_b).try_cast("int")
    count = F.regexp_extract(file_name, rf"_({_INT})\.[^._]*\z", 1).try_cast("int")
    return F.struct(
        F.coalesce(number, F.lit(0)).alias("batch_no"),
        F.when(number.isNull(), 0).otherwise(F.coalesce(count, F.lit(0))).alias("declared_count"),
    )


def dataset_base(name: Column) -> Column:
    """The name up to its last ``_``, or all of it."""
    return F.when(name.contains("_"), F.regexp_extract(name, r"^(?s)(.*)_[^_]*\z", 1)).otherwise(name)


def target_batch_size(name: Column) -> Column:
    """The integer after the last ``_`` (of the whole name when there is none), else null."""
    return F.nullif(F.regexp_extract(name, rf"(?:^|_)({_INT})\z", 1), F.lit("")).try_cast("int")


def split_hosts(text: Column) -> Column:
    """Stored comma-joined hosts as a sorted array: trimmed, no blanks, no word ``null``, distinct."""
    blank = F.lit("".join(map(chr, range(33))))  # space and the control characters
    parts = F.split(F.coalesce(text, F.lit("")), ",")
    parts = F.transform(parts, lambda h: F.trim(h, blank))
    kept = F.filter(parts, lambda h: (h != "") & (h != "null"))
    return F.array_sort(F.array_distinct(kept))


def join_hosts(hosts: Column) -> Column:
    """An array of hosts as comma-joined text."""
    return F.concat_ws(",", hosts)
