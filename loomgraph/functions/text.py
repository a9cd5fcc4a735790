"""Column functions on text: tokens, blank and unsafe text, identifiers, paths, slices."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Ideographs that make up a run, and Latin tokens (fixed values).
IDEOGRAPHS = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"
LATIN = r"[A-Za-z0-9]+(?:[._-][A-Za-z0-9]+)*"
#: Drive letters and network shares of private folders (fixed value).
PRIVATE_PATH = r"(?i)(?:^|[^A-Z0-9])[A-Z]:[\\/]|\\\\(?:users|home|private|documents)[\\/]"
#: Absolute paths of common systems, case as written (fixed value).
ABSOLUTE_PATH = r"(?:(?:^|[^A-Z0-9])[A-Z]:[\\/]|\\\\|/(?:home|Users|mnt|opt|private|root|tmp|var|workspace)(?:/|$))"
#: What is replaced in public messages (fixed value).
PATH_IN_MESSAGE = r"""(?:(?:[A-Za-z]:[\\/])|(?:\\\\))[^\s"'<>;,)]*"""
#: Patterns of private paths and secrets by name (fixed values).
SECRETS = {
    "windows_absolute_path": r"(?i)(?:^|[^A-Z0-9])[A-Z]:[\\/]",
    "windows_user_path": r"(?i)[A-Z]:\\Users\\[^\\\s]+",
    "unix_home_path": r"/(?:home|Users)/[^/\s]+",
    "credential_assignment": r"""(?i)(?:api[_-]?key|access[_-]?token|client[_-]?secret|password)\s*[:=]\s*['"]?[A-Za-z0-9_\-]{12,}""",
    "github_token": r"(?:ghp|gho|github_pat)_[A-Za-z0-9_]{20,}",
}
BLANK = r"(?U)\A[\s\x{1C}-\x{1F}]*\z"


def tokens(text: Column) -> Column:
    """Tokens of a text, with repeats: the characters, then the adjacent pairs, of each ideograph run; Latin tokens in lower case.

    Null gives an empty array.
    """
    runs = F.regexp_extract_all(text, F.lit(f"([{IDEOGRAPHS}]+|{LATIN})"), F.lit(1))

    def of_run(r: Column) -> Column:
        n = F.length(r)
        chars = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(r, i, F.lit(1)))
        pairs = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(r, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
        return F.when(r.rlike("^[A-Za-z0-9]"), F.array(F.lower(r))).otherwise(F.concat(chars, pairs))

    return F.coalesce(F.flatten(F.transform(runs, of_run)), F.array().cast("array<string>"))


def is_blank(text: Column) -> Column:
    """Null, empty, or nothing but white space of any script."""
    return text.isNull() | text.rlike(BLANK)


def is_unsafe(text: Column) -> Column:
    """Blank, or with a NUL character."""
    return is_blank(text) | (F.instr(text, "\x00") > 0)


def has_private_path(text: Column) -> Column:
    return F.coalesce(text.rlike(PRIVATE_PATH), F.lit(False))


def has_absolute_path(text: Column) -> Column:
    return F.coalesce(text.rlike(ABSOLUTE_PATH), F.lit(False))


def secrets(text: Column) -> Column:
    """Names of the patterns that match, in one pass over the text."""
    return F.array_compact(F.array(*[F.when(text.rlike(rx), F.lit(name)) for name, rx in SECRETS.items()]))


def redact_paths(text: Column) -> Column:
    """Absolute paths become <path>."""
    return F.regexp_replace(text, PATH_IN_MESSAGE, "<path>")


def is_identifier(text: Column, longest: int = 128) -> Column:
    return F.coalesce(text.rlike(rf"\A[A-Za-z0-9][A-Za-z0-9._-]{{0,{longest - 1}}}\z"), F.lit(False))


def is_sha256(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\A[0-9a-f]{64}\z"), F.lit(False))


def unified_lines(text: Column) -> Column:
    """CR LF and CR become LF."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def cut(text: Column, start: Column, end: Column) -> Column:
    """Characters ``[start, end)`` counted from 0."""
    return F.substring(text, start + 1, end - start)


def embedding_text(title: Column, body: Column, applicability: Column) -> Column:
    """Title, line feed, body, line feed, applicability by line feeds."""
    return F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit("")), F.coalesce(F.array_join(applicability, "\n"), F.lit("")))


def has_ideograph(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[\x{4E00}-\x{9FFF}]"), F.lit(False))


def is_safe_relative_path(path: Column) -> Column:
    """Neither absolute, nor on a drive, nor climbing out."""
    return F.coalesce(~path.rlike(r"\A[/\\]|\A[A-Za-z]:|(?:\A|[/\\])\.\.(?:[/\\]|\z)") & (path != ""), F.lit(False))
