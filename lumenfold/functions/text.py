"""Column expressions for text. All but the word splitter stay inside the JVM."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfold.schema import DEFAULT_ID_PREFIX, STOP_WORDS

# The characters Python's str methods and re treat as white space.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

SLICE = 512
_WORD = re.compile("[a-z0-9]+")
_STOP = frozenset(STOP_WORDS)


def split_words(text: str | None) -> list[str]:
    """Lower-case ASCII words of a text, without stop words and plain numbers."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    return [w for w in _WORD.findall(text.lower()) if w not in _STOP and not w.isdigit()]


def slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """A batch in parts of ``SLICE`` rows at most, which hold about ``most`` bytes of text unless one row has more:
    only one part's words exist as Python objects."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and (at - start == SLICE or held + size > most):
            yield texts.slice(start, at - start)
            start, held = at, 0
        held += size
    if len(texts) > start:
        yield texts.slice(start)


@F.arrow_udf(T.ArrayType(T.StringType()))
def words(texts: pa.Array) -> pa.Array:
    """Words of each text. Spark has no compatibility decomposition, and an Arrow
    batch through the regex engine measured several times faster than a chain of
    SQL string and array functions."""
    return _each_text(texts, split_words)


@F.arrow_udf(T.ArrayType(T.StringType()))
def distinct_words(texts: pa.Array) -> pa.Array:
    """Words of each text, each once, at their first place: repeats do not leave Python."""
    return _each_text(texts, lambda text: list(dict.fromkeys(split_words(text))))


def _each_text(texts: pa.Array, split: Callable[[str | None], list[str]]) -> pa.Array:
    kind = pa.list_(pa.string())
    parts = [pa.array([split(t) for t in part.to_pylist()], kind) for part in slices(texts)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def collapse(text: Column) -> Column:
    """Turn every run of white space into one blank and strip the ends."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def present(text: Column) -> Column:
    """The text, or null where it is empty (an empty string counts as missing)."""
    return F.nullif(text, F.lit(""))


def first_present(*texts: Column) -> Column:
    return F.coalesce(*[present(t) for t in texts])


def title_case(text: Column) -> Column:
    """Upper-case each letter that does not follow a letter, lower-case the others."""
    cased = r"[\p{Lu}\p{Ll}\p{Lt}]"
    runs = F.regexp_extract_all(text, F.lit(rf"{cased}+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+"), F.lit(0))
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(r.substr(F.lit(2), F.length(r))))),
        "",
    )


def clean_markup(text: Column) -> Column:
    """Line breaks to newlines, tags removed, five entities decoded, white space collapsed.

    The ampersand is decoded first, so a doubly escaped bracket comes out bare.
    """
    text = F.regexp_replace(text, rf"<br{SPACE}*/?>", "\n")
    text = F.regexp_replace(text, r"<[^>]+>", "")
    for coded, plain in [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]:
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return collapse(text)


def shorten(text: Column, limit: int = 420) -> Column:
    """Collapsed text; beyond ``limit`` characters cut at the last blank and mark the cut."""
    text = collapse(text)
    head = F.substring(text, 1, limit - 1)
    cut = F.regexp_replace(F.regexp_replace(head, r"(?s) [^ ]*$", ""), f"{SPACE}+$", "")
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(cut, F.lit("...")))


def class_slug(name: Column) -> Column:
    """Kebab-case id of a class name; every capital after a letter or digit starts a part."""
    dashed = F.regexp_replace(name, r"(?<=[\p{L}\p{N}])(?=\p{Lu})", "-")
    squeezed = F.regexp_replace(F.lower(F.regexp_replace(dashed, r"[^\p{L}\p{N}]", "-")), "-+", "-")
    return F.coalesce(present(F.regexp_replace(squeezed, "^-|-$", "")), F.lit("activity"))


def collection_slug(value: Column) -> Column:
    """A collection id with only lower-case letters, digits, ``_``, ``.``, ``/`` and ``-``."""
    runs = F.regexp_replace(F.lower(strip(value)), r"[^a-zA-Z0-9_./-]+", "-")
    return F.coalesce(present(F.regexp_replace(runs, "^-+|-+$", "")), F.lit("content"))


def safe_filename(title: Column) -> Column:
    runs = F.regexp_replace(title, "[^a-zA-Z0-9]+", "-")
    return F.concat(F.lower(F.regexp_replace(runs, "^-+|-+$", "")), F.lit(".md"))


def display_filename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def id_prefix(prefix: str) -> str:
    """Clean a prefix parameter (a single driver-side string, not data)."""
    plain = unicodedata.normalize("NFKD", prefix).encode("ascii", "ignore").decode()
    return re.sub("[^a-z0-9]+", "-", plain.lower()).strip("-") or DEFAULT_ID_PREFIX


def fixed(value: Column, decimals: int) -> Column:
    """A number with this many decimals, rounded as its exact binary value (the JVM rounds the decimal text)."""

    @F.arrow_udf(T.StringType())
    def write(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else f"{v:.{decimals}f}" for v in values.to_pylist()], pa.string())

    return write(value.cast("double"))
