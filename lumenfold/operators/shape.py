"""Raw rows to entries: renaming, cleaning, dating, tagging, collections, embedding text.

Every function takes and returns a DataFrame and is a narrow projection unless
its docstring names a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfold.functions import text as tx
from lumenfold.functions.index import dense_index
from lumenfold.schema import ID_FIELDS, SCOPE, TEXT_FIELDS


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


# --- raw comment rows -------------------------------------------------------


def normalize_rows(df: DataFrame, as_of: str) -> DataFrame:
    """Bring both source spellings of a comment row to one set of columns.

    An empty string counts as missing and falls through to the other spelling.
    """
    get = lambda name: column_or_null(df, name)
    user_id = F.coalesce(tx.first_present(get("user_id"), get("userID")), F.lit(""))
    recipe = F.coalesce(tx.first_present(get("recipe_name"), get("recipeName")), F.lit(""))
    comment = F.coalesce(tx.first_present(get("comment"), get("commentBody")), F.lit(""))
    return df.select(
        column_or_null(df, "seq", "long").alias("seq"),
        F.coalesce(tx.first_present(get("user_key"), get("userDisplayName")), user_id).alias("user_key"),
        user_id.alias("user_id"),
        tx.strip(recipe).alias("recipe_name"),
        tx.clean_markup(comment).alias("comment"),
        parse_date(get("date"), get("approveDate"), as_of).alias("date"),
    )


def parse_date(date: Column, epoch_seconds: Column, as_of: str) -> Column:
    """First ten characters of a date, else the UTC day of epoch seconds, else ``as_of``."""
    from_epoch = F.date_format(F.timestamp_seconds(F.floor(tx.present(epoch_seconds).cast("double"))), "yyyy-MM-dd")
    return F.coalesce(F.substring(tx.present(date), 1, 10), from_epoch, F.lit(as_of))


def filter_users(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Keep rows whose ``user_key`` is listed in ``users``."""
    return rows.join(users.select("user_key"), "user_key", "left_semi")


def filter_user(rows: DataFrame, user: str, target_id: str | None = None) -> DataFrame:
    """Keep rows of one user, named by key or by id."""
    return rows.where((F.col("user_key") == user) | (F.col("user_id") == (target_id or user)))


def group_entries(rows: DataFrame, users: DataFrame | None = None, min_len: int = 50, label: str = "Recipe: ") -> DataFrame:
    """One entry per (user, recipe), its notes the comments in arrival order.

    Rows without a recipe or with at most ``min_len`` characters are dropped.
    An entry is one row, so the comments of a pair meet in it, whatever their
    number. One shuffle.
    """
    if users is not None:
        rows = filter_users(rows, users)
    pair = ["user_id", "recipe_name"]
    kept = rows.where((F.col("recipe_name") != "") & (F.length("comment") > min_len))
    title = tx.title_case(F.regexp_replace("recipe_name", "-", " "))
    return (
        kept.groupBy(*pair)
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("seq", "comment"))), lambda c: c["comment"]), "\n\n"
            ).alias("notes"),
            F.max("date").alias("created_at"),
            F.min_by("user_key", "seq").alias("user_key"),
            F.min("seq").alias("seq"),
        )
        .select(
            "user_id", "user_key", "recipe_name", "seq",
            title.alias("title"),
            F.concat(F.lit(label), title).alias("content"),
            "notes",
            "created_at",
            F.to_json(F.struct("user_key", "user_id", "recipe_name")).alias("metadata"),
        )
    )


def order_entries(entries: DataFrame) -> DataFrame:
    """Total order by user key, date and recipe (a range-partitioned sort)."""
    return entries.orderBy("user_key", "created_at", "recipe_name")


# The observation rules. phrases → (suffix, topic, summary pattern).
OBSERVATION_RULES = [
    (["substitut", "instead"], "substitutions", "substitutions", "{user} often adapts {recipe} around available ingredients."),
    (["again", "keeper", "repertoire"], "repeat", "repeat-worthy recipes", "{user} marked {recipe} as worth returning to."),
    (["too sweet", "less sugar"], "sweetness", "sweetness adjustments", "{user} tends to reduce sweetness in {recipe}."),
]


def derive_observations(entries: DataFrame, rules=OBSERVATION_RULES) -> DataFrame:
    """Each entry becomes one comment activity plus one row per rule its notes trigger."""
    lowered = F.lower("notes")
    comment_id = F.concat_ws(":", F.lit("recipe-comment"), "user_id", "recipe_name")
    nothing = F.lit(None).cast("string")
    row = lambda kind, ident, topic, summary, source: F.struct(
        F.lit(kind).alias("kind"), ident.alias("id"), topic.alias("topic"), summary.alias("summary"), source.alias("source_activity_id")
    )
    made = [row("recipe_comment", comment_id, nothing, F.col("notes"), nothing)]
    for phrases, suffix, topic, pattern in rules:
        hit = F.lit(False)
        for phrase in phrases:
            hit = hit | lowered.contains(phrase)
        before, after = pattern.replace("{user}", "").split("{recipe}")
        made.append(
            F.when(
                hit,
                row(
                    "observed_preference",
                    F.concat_ws(":", F.lit("observed-preference"), "user_id", "recipe_name", F.lit(suffix)),
                    F.lit(topic),
                    F.concat(F.col("user_key"), F.lit(before), F.col("recipe_name"), F.lit(after)),
                    comment_id,
                ),
            )
        )
    return entries.withColumn("activity", F.explode(F.filter(F.array(*made), lambda a: a.isNotNull()))).select(
        "user_id", "user_key", "recipe_name", "created_at", "activity.*"
    )


# --- entries ----------------------------------------------------------------


@F.pandas_udf(T.StringType())
def _sorted_json(metadata):
    import json

    fold = lambda m: None if m is None else json.dumps(json.loads(m), ensure_ascii=False, sort_keys=True)
    return metadata.map(fold)


def fold_metadata(content: Column, metadata: Column) -> Column:
    """Content followed by its metadata as JSON with sorted keys; unchanged when there is none."""
    empty = metadata.isNull() | metadata.isin("", "{}")
    return F.when(empty, content).otherwise(F.concat(content, F.lit("\n\nMetadata: "), _sorted_json(metadata)))


def activity_transform(df: DataFrame) -> DataFrame:
    """Activities (title, content, created_at, source_id, classes, metadata) to entries.

    A falsy source id gives no id, an empty class list no collections; absent is null.
    """
    slugs = F.transform("classes", tx.class_slug)
    return df.withColumns(
        {
            "content": fold_metadata(F.col("content"), F.col("metadata")),
            "id": tx.present(F.col("source_id")),
            "source_id": tx.present(F.col("source_id")),
            "collections": F.when(F.size("classes") > 0, slugs),
        }
    ).drop("classes", "metadata")


def map_fields(df: DataFrame, field_map: Mapping[str, str | Column], keep: list[str] | None = None) -> DataFrame:
    """Build entry fields from source columns or column expressions.

    A missing source column gives an empty string, for ``tags`` an empty array.
    """
    made = []
    for target, source in field_map.items():
        if isinstance(source, Column):
            made.append(source.alias(target))
        elif source in df.columns:
            made.append(F.col(source).alias(target))
        else:
            empty = F.array().cast("array<string>") if target == "tags" else F.lit("")
            made.append(empty.alias(target))
    return df.select(*(keep or []), *made)


def clean_collections(values: Column) -> Column:
    """Sanitised, de-duplicated in order; null when nothing is left."""
    slugs = F.array_distinct(F.transform(F.filter(values, lambda v: v.isNotNull()), tx.collection_slug))
    return F.when(F.size(slugs) > 0, slugs)


def map_collections(df: DataFrame, hook: Column | None = None) -> DataFrame:
    """Settle ``collection`` / ``collections``.

    The hook (an array expression) is asked only for rows with neither field and
    yields the singular field for one value, the plural one for more. A row's own
    ``collection`` keeps its first value; non-empty ``collections`` replaces it.
    """
    own_single = column_or_null(df, "collection")
    own_many = column_or_null(df, "collections", "array<string>")
    if hook is not None:
        unset = own_single.isNull() & own_many.isNull()
        hooked = F.when(unset, clean_collections(hook))
        own_single = F.coalesce(own_single, F.when(F.size(hooked) == 1, hooked[0]))
        own_many = F.coalesce(own_many, F.when(F.size(hooked) > 1, hooked))
    many = clean_collections(own_many)
    single = F.when(many.isNull() & own_single.isNotNull(), tx.collection_slug(own_single))
    return df.withColumns({"_many": many, "_single": single}).withColumns(
        {"collections": F.col("_many"), "collection": F.col("_single")}
    ).drop("_many", "_single")


def primary_collection(df: DataFrame, corpus: str = "content") -> DataFrame:
    """First collection of an entry, else its single one, else the corpus name."""
    return df.withColumn(
        "primary_collection",
        F.coalesce(F.get("collections", F.lit(0)), F.col("collection"), tx.collection_slug(F.lit(corpus))),
    )


def clean_tags(tags: Column, kind: str = "array") -> Column:
    """Tags without nulls and empty strings; duplicates stay, null becomes empty.

    With ``kind`` "scalar" the column holds one tag, not an array.
    """
    tags = F.array(tags.cast("string")) if kind == "scalar" else tags
    kept = F.filter(tags, lambda t: t.isNotNull() & (t != ""))
    return F.coalesce(kept, F.array().cast("array<string>"))


def validate_collections(df: DataFrame, declared: DataFrame, ids: list[str]) -> DataFrame:
    """Entries (``ids`` columns) that name an undeclared collection, with the sorted unknown ids.

    Only the plural field is checked. With nothing declared nothing is rejected.
    """
    named = df.select(*ids, F.explode("collections").alias("collection_id")).distinct()
    any_declared = declared.select(F.lit(1).alias("_any")).limit(1)
    return (
        named.join(declared.select("collection_id"), "collection_id", "left_anti")
        .withColumn("_any", F.lit(1))
        .join(any_declared, "_any", "left_semi")
        .groupBy(*ids)
        .agg(F.array_sort(F.collect_set("collection_id")).alias("unknown"))
    )


def require_declared(df: DataFrame, declared: list[str]) -> DataFrame:
    """Strict form: the job fails on the first entry naming an undeclared collection."""
    if not declared:
        return df
    unknown = F.array_sort(F.array_except(F.coalesce("collections", F.array()), F.array(*map(F.lit, declared))))
    failed = F.raise_error(F.concat(F.lit("Unknown collection(s): "), F.array_join(unknown, ", ")))
    return df.withColumn("collections", F.when(F.size(unknown) > 0, failed.cast("array<string>")).otherwise(F.col("collections")))


def created_at(value: Column) -> Column:
    """ISO text (naive means UTC), a date, or epoch milliseconds as one instant."""
    millis = F.timestamp_millis(F.when(value.rlike("^-?[0-9]+$"), value).cast("long"))
    zoned = value.rlike("([zZ]|[+-][0-9]{2}:?[0-9]{2})$")
    utc = F.when(zoned, value).when(value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.concat(value, F.lit("T00:00:00Z")))
    utc = utc.when(value.rlike("[T ][0-9]{1,2}:[0-9]{1,2}$"), F.concat(value, F.lit(":00Z")))
    return F.coalesce(millis, F.try_to_timestamp(utc.otherwise(F.concat(value, F.lit("Z")))))


def resolve_entry_id(df: DataFrame, seq: str = "seq") -> DataFrame:
    """``entry_index`` per scope in arrival order, and the entry's id.

    The id is the first non-empty of the id fields, else ``entry-<index>``. The
    numbering shuffles by (scope, arrival range), never a whole scope at once.
    """
    indexed = dense_index(df, SCOPE, seq)
    found = [tx.present(F.col(c).cast("string")) for c in ID_FIELDS if c in df.columns]
    return indexed.withColumn("portable_id", F.coalesce(*found, F.lit(None).cast("string"))).withColumn(
        "entry_id", F.coalesce("portable_id", F.concat(F.lit("entry-"), F.col("entry_index")))
    )


def embedding_text(df: DataFrame) -> Column:
    """Non-empty text fields in fixed order, each collapsed, joined by blank lines."""
    parts = []
    for name in TEXT_FIELDS:
        if name not in df.columns:
            continue
        value = F.col(name)
        if dict(df.dtypes)[name].startswith("array"):
            value = F.array_join(F.filter(value, lambda v: v.isNotNull() & (v != "")), " ")
        parts.append(tx.present(tx.collapse(value.cast("string"))))
    return F.concat_ws("\n\n", *parts)


def all_text(df: DataFrame) -> Column:
    """Non-empty text fields in fixed order joined by a blank (for words and excerpts)."""
    return F.concat_ws(" ", *[tx.present(F.col(name).cast("string")) for name in TEXT_FIELDS if name in df.columns])


def normalize_entries(df: DataFrame) -> DataFrame:
    """Bare strings (a one-column string frame next to its keys) become entries with a ``text`` field."""
    kinds = dict(df.dtypes)
    if "value" in kinds and "text" not in kinds:
        if kinds["value"] != "string":
            raise TypeError("entries must be rows with named fields or strings")
        return df.withColumnRenamed("value", "text")
    return df


def with_builder_text(df: DataFrame, builder: Column | Callable[[DataFrame], Column] | None) -> DataFrame:
    """Store a custom text in ``text``; a null from the builder fails the job."""
    if builder is None:
        return df
    value = builder(df) if callable(builder) and not isinstance(builder, Column) else builder
    checked = F.when(value.isNull(), F.raise_error("Entry text builder returned null").cast("string")).otherwise(value)
    return df.withColumn("text", checked)
