"""Column masking, row scoping and classification as DataFrame transforms by role."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType, VariantType

from vigilmart import settings
from vigilmart.functions.columns import mask_ssn, normal_role

# Dotted paths, split; the empty path is the value itself.
Paths = frozenset[tuple[str, ...]]


def branch_access(spark: SparkSession) -> DataFrame:
    """The default role-to-branch mapping."""
    branches = ", ".join(f"({n})" for n in settings.ANALYST_BRANCHES)
    return spark.sql(
        f"SELECT 'COMPLIANCE_ANALYST' AS role_name, branch_id FROM VALUES {branches} AS v(branch_id)"
    )


def scopes(dim_customer: DataFrame, dim_account: DataFrame) -> dict[str, DataFrame]:
    """The branch behind each key that rows without a branch can be scoped by.

    Customers count with their current version. The account keys come with the branch of the
    customer that owns the account.
    """
    current = dim_customer.where("is_current").select("customer_id", "branch_id")
    owned = dim_account.join(current, "customer_id")
    return {
        "customer_id": current,
        "account_id": owned.select("account_id", "branch_id"),
        "account_sk": owned.select("account_sk", "branch_id"),
    }


def _at(df: DataFrame, name: str, kind: str) -> Column | None:
    """A column, or the field of that name in a VARIANT ``data``."""
    if name in df.columns:
        return F.col(name)
    if "data" in df.columns and isinstance(df.schema["data"].dataType, VariantType):
        return F.try_variant_get("data", f"$.{name}", kind)
    return None


def row_access(
    df: DataFrame,
    role: str,
    mapping: DataFrame,
    entity: str | None = None,
    ways: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows of the branches mapped to the role; open roles see every row.

    Rows are scoped by their branch or, where ``entity`` or the lack of a branch says so, by
    the branch behind one of their keys (``ways``, see ``scopes``). Rows of unknown branch are
    hidden. A frame that can't be scoped is an error, not an open door.
    """
    name = normal_role(role)
    if name in settings.ALL_BRANCH_ROLES:
        return df
    visible = mapping.where(F.col("role_name") == name).select("branch_id")
    by = settings.SCOPED_BY.get(entity) if entity else None
    if by is None:
        by = next((c for c in ("branch_id", *(ways or {})) if c in df.columns), None)
    key = _at(df, by, "int" if by == "branch_id" else "bigint") if by else None
    if key is None or (by != "branch_id" and by not in (ways or {})):
        raise ValueError(f"rows of {entity or df.columns} have no branch, and no key in {sorted(ways or {})}")
    if by != "branch_id":
        visible = ways[by].join(visible, "branch_id", "left_semi").select(by)
    scoped = df.withColumn("_scope", key).join(visible.toDF("_scope"), "_scope", "left_semi")
    return scoped.select(*df.columns)


def classify(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Tag columns with their sensitivity class, kept in the schema and in written files."""
    for column, tag in tags.items():
        if tag not in settings.CLASSIFICATIONS:
            raise ValueError(f"{tag!r} is not one of {settings.CLASSIFICATIONS}")
        known = df.schema[column].metadata
        df = df.withMetadata(column, {**known, settings.CLASSIFICATION_TAG: tag})
    return df


def classifications(df: DataFrame) -> dict[str, str]:
    tagged = {f.name: f.metadata.get(settings.CLASSIFICATION_TAG) for f in df.schema.fields}
    return {name: tag for name, tag in tagged.items() if tag}


def _is_sensitive(name: Column) -> Column:
    return F.lower(F.trim(name)).isin(*settings.SENSITIVE_NAMES)


def _masked_variant(value: Column, role: str, paths: Paths, depth: int = 2) -> Column:
    """The object rebuilt without plain values at ``paths`` or under sensitive names.

    Objects inside are rebuilt down to ``depth``; deeper ones, lists and bare values that name
    something sensitive are hidden.
    """
    here = {path[0] for path in paths if len(path) == 1}
    below = {name: frozenset(p[1:] for p in paths if p[0] == name and len(p) > 1) for name in {p[0] for p in paths}}
    fields = F.try_variant_get(value, "$", "map<string,variant>")

    def kept(name: Column, inner: Column) -> Column:
        text = F.try_variant_get(inner, "$", "string")
        out = F.when(_is_sensitive(name) | name.isin(*here), mask_ssn(text, role).cast("variant"))
        if depth:
            for child, more in below.items():
                if more:
                    out = out.when(name == child, _masked_variant(inner, role, more, depth - 1))
        named = "|".join(settings.SENSITIVE_NAMES)
        inside = F.regexp_like(F.schema_of_variant(inner), F.lit(rf"(?i)(^|[^\w])({named})`?:"))
        hidden = _masked_variant(inner, role, frozenset(), depth - 1) if depth else F.lit(None).cast("variant")
        return out.when(inside, hidden).otherwise(inner)

    return F.to_variant_object(F.transform_values(fields, kept))


def _masked(value: Column, kind: DataType, role: str, paths: Paths) -> Column:
    """A value of any type without the restricted parts inside it."""
    if isinstance(kind, VariantType):
        return _masked_variant(value, role, paths)
    if isinstance(kind, StructType):
        parts = [_masked_field(value[f.name], f, role, frozenset(p[1:] for p in paths if p[0] == f.name)).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _masked(x, kind.elementType, role, paths))
    if isinstance(kind, MapType) and isinstance(kind.keyType, StringType):

        def entry(name: Column, inner: Column) -> Column:
            plain = _masked(inner, kind.valueType, role, paths)
            return F.when(_is_sensitive(name), _blank(inner, kind.valueType, role)).otherwise(plain)

        return F.transform_values(value, entry)
    return value


def _blank(value: Column, kind: DataType, role: str) -> Column:
    """A restricted value: the last four of a text, nothing of any other type."""
    if isinstance(kind, StringType):
        return mask_ssn(value, role)
    if isinstance(kind, VariantType):
        return mask_ssn(F.try_variant_get(value, "$", "string"), role).cast("variant")
    return F.lit(None).cast(kind)


def _masked_field(value: Column, field: StructField, role: str, below: Paths) -> Column:
    tagged = field.metadata.get(settings.CLASSIFICATION_TAG) == "PII_RESTRICTED"
    if tagged or () in below or field.name.strip().lower() in settings.SENSITIVE_NAMES:
        return _blank(value, field.dataType, role)
    return _masked(value, field.dataType, role, frozenset(p for p in below if p))


def masked(df: DataFrame, role: str, entity: str | None = None) -> DataFrame:
    """Mask what is restricted, wherever it is, for roles that aren't cleared for it.

    Restricted are columns and fields tagged so, those at the paths that the policies name for
    ``entity``, and those of a sensitive name, tagged or not. They are found inside structs,
    arrays and maps; a VARIANT holds the fields of its entity and is rebuilt.
    """
    if normal_role(role) in settings.UNMASKED_ROLES:
        return df
    paths = frozenset(tuple(p.split(".")) for p in settings.RESTRICTED_PATHS.get(entity or "", ()))

    def seen(f: StructField) -> Column:
        if isinstance(f.dataType, VariantType):
            below = paths
        else:
            below = frozenset(p[1:] for p in paths if p[0] == f.name)
        return _masked_field(F.col(f"`{f.name}`"), f, role, below).alias(f.name, metadata=f.metadata)

    return df.select(*[seen(f) for f in df.schema])


def governed(
    df: DataFrame,
    role: str,
    mapping: DataFrame,
    entity: str | None = None,
    ways: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The frame as the role may see it; reports take it in place of the plain dimension."""
    return masked(row_access(df, role, mapping, entity, ways), role, entity)


def classified_columns(df: DataFrame) -> DataFrame:
    """Where sensitive data lives: rows, filled rows and distinct values per tagged column.

    Values are counted per column and value first, so a frequent value is summed up where
    it is read and no column is gathered whole.
    """
    tags = classifications(df)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(tag).alias("classification"),
                F.col(c).cast("string").alias("value"),
            )
            for c, tag in tags.items()
        ]
    )
    per_value = (
        df.select(F.inline(cells))
        .groupBy("column_name", "classification", "value")
        .agg(F.count("*").alias("n"))
    )
    filled = F.col("value").isNotNull()
    return per_value.groupBy("column_name", "classification").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("filled_count"),
        F.count("value").alias("distinct_count"),
    )


def masked_sample(
    dim_customer: DataFrame, mapping: DataFrame, roles: tuple[str, ...], n: int = 5
) -> DataFrame:
    """The first customers of the analyst branches as each role sees them."""
    samples = None
    for role in roles:
        seen = governed(dim_customer.where(F.col("branch_id").isin(*settings.ANALYST_BRANCHES)), role, mapping)
        sample = (
            seen.select("customer_id", "full_name", "ssn", "branch_id")
            .orderBy("customer_id")
            .limit(n)
            .select(F.lit(role).alias("role_name"), "*")
        )
        samples = sample if samples is None else samples.unionByName(sample)
    return samples


def rows_visible_by_role(
    dim_customer: DataFrame, mapping: DataFrame, roles: tuple[str, ...]
) -> DataFrame:
    """Rows each role sees, counted from one count per branch."""
    per_branch = dim_customer.groupBy("branch_id").agg(F.count("*").alias("n"))
    counts = None
    for role in roles:
        count = (
            row_access(per_branch, role, mapping)
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_visible"))
            .select(F.lit(role).alias("role_name"), "rows_visible")
        )
        counts = count if counts is None else counts.unionByName(count)
    return counts


def visible_branches(dim_customer: DataFrame, role: str, mapping: DataFrame) -> DataFrame:
    branches = dim_customer.select("branch_id").distinct()
    return row_access(branches, role, mapping).orderBy("branch_id")
