"""Identity claims and directory entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.text import first_value, first_word, is_blank, last_word, strip

# Admin roles, and the rules for new directory entries.
LDAP_ADMIN = "ldap-admin"
DATA_ADMINS = ("ldap-admin", "data-admin", "platform-admin", "realm-admin")
USERNAME_PATTERN = r"\A[a-zA-Z0-9._-]+\z"
USERNAME_LENGTH = (3, 64)
FULL_NAME_LENGTH = (1, 120)
EMAIL_LENGTH = (3, 254)
DEPARTMENT_LENGTH = (0, 120)

_NO_ROLES = "array<string>"


def _roles(c: Column) -> Column:
    return F.coalesce(c, F.array().cast(_NO_ROLES))


def claims_projection(claims: DataFrame) -> DataFrame:
    """Profile columns of identity claims; absent roles are an empty list."""
    return claims.select(
        F.col("sub").alias("user_id"),
        F.col("preferred_username").alias("username"),
        "email",
        "name",
        _roles(F.col("realm_access.roles")).alias("roles"),
    )


def has_role(role: str = LDAP_ADMIN) -> Column:
    """Whether the realm roles of a claims row hold one role."""
    return F.array_contains(_roles(F.col("realm_access.roles")), role)


def has_any_role(allowed: tuple[str, ...] = DATA_ADMINS) -> Column:
    """Whether the direct or the realm roles hold any allowed role."""
    held = F.array_union(_roles(F.col("roles")), _roles(F.col("realm_access.roles")))
    return F.coalesce(F.arrays_overlap(held, F.array(*[F.lit(r) for r in allowed])), F.lit(False))


def admin_users(claims: DataFrame) -> DataFrame:
    """Users with any admin role; ``is_ldap_admin`` tells which may edit the directory."""
    return claims.where(has_any_role()).select(
        F.col("sub").alias("user_id"),
        F.col("preferred_username").alias("username"),
        has_role().alias("is_ldap_admin"),
    )


def directory_list(entries: DataFrame) -> DataFrame:
    """First value of each attribute list, empty text when there is none."""
    return entries.select(
        first_value(F.col("uid")).alias("username"),
        first_value(F.col("cn")).alias("full_name"),
        first_value(F.col("mail")).alias("email"),
        first_value(F.col("departmentNumber")).alias("department"),
    )


def _length_in(c: Column, bounds: tuple[int, int]) -> Column:
    return F.coalesce(F.length(c).between(*bounds), F.lit(False))


def is_valid_entry() -> Column:
    username, full_name = F.col("username"), F.col("full_name")
    return (
        _length_in(username, USERNAME_LENGTH)
        & username.rlike(USERNAME_PATTERN)
        & _length_in(full_name, FULL_NAME_LENGTH)
        & ~is_blank(full_name)
        & _length_in(F.col("email"), EMAIL_LENGTH)
        & _length_in(F.coalesce("department", F.lit("")), DEPARTMENT_LENGTH)
    )


def directory_entries(requests: DataFrame) -> DataFrame:
    """Valid requests as directory attributes; other request columns are kept in front."""
    used = ("username", "full_name", "email", "department")
    kept = [c for c in requests.columns if c not in used]
    department = strip(F.coalesce("department", F.lit("")))
    return requests.where(is_valid_entry()).select(
        *kept,
        F.col("username").alias("uid"),
        strip(F.col("full_name")).alias("cn"),
        last_word(F.col("full_name")).alias("sn"),
        first_word(F.col("full_name")).alias("givenName"),
        strip(F.col("email")).alias("mail"),
        F.nullif(department, F.lit("")).alias("departmentNumber"),
    )


def _first_requests(entries: DataFrame, existing: DataFrame, seq: str) -> DataFrame:
    """(uid, seq) of the request that gets each free uid: the first one to ask for it."""
    firsts = entries.groupBy("uid").agg(F.min(seq).alias(seq))
    return firsts.join(existing.select("uid").distinct(), "uid", "left_anti")


def new_entries(entries: DataFrame, existing: DataFrame, seq: str = "seq") -> DataFrame:
    """Entries whose uid is free. The join is on (uid, seq), so a uid asked for often is spread out."""
    return entries.join(_first_requests(entries, existing, seq), ["uid", seq], "left_semi")


def duplicate_entries(entries: DataFrame, existing: DataFrame, seq: str = "seq") -> DataFrame:
    """Entries refused because the uid is present or an earlier request took it."""
    return entries.join(_first_requests(entries, existing, seq), ["uid", seq], "left_anti")
