"""Column expressions on text: cleaning, coercion, names, labels and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layout of branch and job names, and how long labels and previews may be.
BRANCH_FOLDER = "research"
NAME_PREFIX = "research"
LABEL_WIDTH, LABEL_KEEP = 45, 42
PREVIEW_WIDTH = 200

_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_INFINITE = r"^[+-]?inf(inity)?$"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any script."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(text, r"\s+", " ")


def status(text: Column) -> Column:
    return F.upper(strip(text))


def number_or_null(text: Column) -> Column:
    """A number written as text; anything else becomes null, as does NaN.

    The pattern keeps out forms that only SQL casts accept, such as ``1.0d``.
    """
    clean = strip(text)
    return (
        F.when(clean.rlike(_NUMBER), clean.try_cast("double"))
        .when(F.lower(clean).rlike(_INFINITE), F.when(clean.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    )


def shorten(text: Column, width: int, keep: int) -> Column:
    """Text longer than ``width`` becomes its first ``keep`` characters and three dots."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, keep), F.lit("..."))).otherwise(text)


def label(text: Column) -> Column:
    return shorten(strip(text), LABEL_WIDTH, LABEL_KEEP)


def preview(text: Column) -> Column:
    return shorten(text, PREVIEW_WIDTH, PREVIEW_WIDTH)


def on_branch(branch: Column, folder: str = BRANCH_FOLDER) -> Column:
    """Whether a branch lies in ``folder`` and has a tag."""
    return branch.startswith(folder + "/")


def safe_tag(branch: Column, folder: str = BRANCH_FOLDER) -> Column:
    """The tag of a branch in lower case, with every character but a-z, 0-9 and - replaced by -."""
    tag = F.lower(F.regexp_replace(branch, f"^{folder}/", ""))
    return F.regexp_replace(F.regexp_replace(tag, "[^a-z0-9-]", "-"), "^-+|-+$", "")


def job_name(branch: Column, commit: Column, folder: str = BRANCH_FOLDER, prefix: str = NAME_PREFIX) -> Column:
    return F.concat_ws("-", F.lit(prefix), safe_tag(branch, folder), commit)


def parse_job_name(name: Column, prefix: str = NAME_PREFIX) -> Column:
    """Tag, round, candidate and commit of ``<prefix>-<tag>-r<round>-<candidate>-<commit>``; null if it differs."""
    form = rf"^{prefix}-(.+)-r(\d+)-(\d+)-([0-9a-f]+)$"
    part = [F.regexp_extract(name, form, i) for i in range(1, 5)]
    return F.when(
        name.rlike(form),
        F.struct(
            part[0].alias("tag"),
            part[1].try_cast("bigint").alias("round"),
            part[2].try_cast("bigint").alias("candidate"),
            part[3].alias("commit"),
        ),
    )


def mb_to_gb(mb: Column) -> Column:
    return F.bround(mb / F.lit(1024), 1)


def bytes_to_gib(size: Column) -> Column:
    return F.bround(size / F.lit(1024**3), 2)


def bytes_to_mib(size: Column) -> Column:
    return size / F.lit(1024 * 1024)


def duration_text(seconds: Column) -> Column:
    whole = seconds.cast("bigint")
    return F.format_string("%dm %02ds", F.floor(whole / 60).cast("bigint"), whole % 60)


def fixed(value: Column, digits: int = 6) -> Column:
    return F.format_string(f"%.{digits}f", value)


def signed(value: Column, digits: int = 6) -> Column:
    return F.format_string(f"%+.{digits}f", value)


def percent(share: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", share * 100)


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


# --------------------------------------------------------------------------- personal data

# Shapes counted by the check for personal data before a dataset is published.
PERSONAL_DATA = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z]",
    "phone": r"\+?[0-9]{1,3}[ -][(]?[0-9]{2,4}[)]?[ -][0-9]{3,4}[ -]?[0-9]{3,4}",
    "card": r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}",
    "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "key": r"(?:sk|pk|ghp|AKIA|xox[a-z])[-_]?[A-Za-z0-9]{16,}",
}


def personal_data_hits(text: Column, kind: str) -> Column:
    return F.regexp_count(text, F.lit(PERSONAL_DATA[kind])).cast("bigint")
