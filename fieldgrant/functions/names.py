"""Column-name hygiene for landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Characters of a landed header that become an underscore.
_SEPARATORS = str.maketrans({" ": "_", "-": "_", "/": "_"})


def normalise_name(raw: str) -> str:
    """Trim, lower-case and turn each separator into ``_`` (runs are not collapsed)."""
    return raw.strip().lower().translate(_SEPARATORS)


def misread_as_latin1(name: str) -> str:
    """The normalised name a UTF-8 header gets when the file is decoded as ISO-8859-1."""
    return normalise_name(name.encode("utf-8").decode("iso-8859-1"))


def unique_names(names: list[str]) -> list[str]:
    """Suffix repeats with ``_2``, ``_3``… in column order, never reusing a taken name."""
    taken = set(names)
    seen: set[str] = set()
    out = []
    for name in names:
        candidate, n = name, 1
        while candidate in seen or (n > 1 and candidate in taken):
            n += 1
            candidate = f"{name}_{n}"
        seen.add(candidate)
        out.append(candidate)
    return out


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its normalised, collision-free name in one projection."""
    return df.toDF(*unique_names([normalise_name(c) for c in df.columns]))


def quoted(name: str) -> str:
    """A column name safe to pass to ``F.col`` (dots, spaces and backticks included)."""
    return "`" + name.replace("`", "``") + "`"
