"""Date normalisation to ``MM/YY`` (O-51).

An ordered cascade: the first branch whose pattern matches and whose value is
valid wins; a branch whose value is invalid falls through to the next.

Branches (applied to the stripped text):
  1. m{1,2} SEP yy or yyyy            -> zfill(m) / last two of year
  2. yyyy                             -> 01 / last two
  3. yyyy SEP m{1,2}                  -> zfill(m) / last two
  4. yy SEP m (one digit)             -> zfill(m) / yy
  5. m{1,2} SEP d{1,2} SEP yyyy       -> zfill(m) / last two
  6. yyyy SEP m{1,2} SEP d{1,2}       -> zfill(m) / last two (no calendar check)
  7. <Month> d{1,2}, yyyy             -> full English month name, valid day
  8. <Month> d{1,2} yyyy              -> same without the comma
  9. ISO 8601 date (calendar or week) with optional time and offset
 10. otherwise NULL
SEP is any of ``/ . -``. Branches 1-6 are decided on the shape of one split
(number of parts and their lengths) so the cascade stays a small expression
that fits whole-stage codegen. ``(?U)`` makes ``\\d``/``\\w``/``\\s`` Unicode
aware, as they are in Python patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.text import ustrip
from fundlake.schemas import MONTH_NAMES

# Digits separated by / . - (at most three groups of one to four digits).
P_NUMERIC = r"(?U)^\d{1,4}(?:[/.-]\d{1,4}){0,2}$"
P_NUMERIC_SPLIT = "[/.-]"
# "<word> <1-2 digits>, <4 digits>" or the same with white space for the comma.
P_TEXTUAL = r"(?U)^\w+\s+\d{1,2}(?:,\s*|\s+)\d{4}$"
P_TEXTUAL_SPLIT = r"(?U)[\s,]+"
# Day-of-month forms a "%d" directive accepts.
P_DAY = r"^(?:3[01]|[12][0-9]|0[1-9]|[1-9])$"
# ISO time: hh[:mm[:ss[.f+]]] or hh[mm[ss[.f+]]], offset Z or +-hh[:mm[:ss[.f+]]].
_TIME = (
    r"(?:[01][0-9]|2[0-3])(?:(:?)[0-5][0-9](?:\1[0-5][0-9](?:[.,][0-9]+)?)?)?"
    r"(?:Z|[+-](?:[01][0-9]|2[0-3])(?::?[0-5][0-9](?::?[0-5][0-9](?:[.,][0-9]+)?)?)?)?"
)
P_ISO_CAL = rf"(?s)^[0-9]{{4}}(?:-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{4}})(?:.{_TIME})?$"
P_ISO_WEEK = rf"(?s)^[0-9]{{4}}(?:-W[0-9]{{2}}(?:-[1-7])?|W[0-9]{{2}}[1-7]?)(?:.{_TIME})?$"


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def days_in_month(year: Column, month: Column) -> Column:
    """Arithmetic month length (no date construction, so nothing can raise)."""
    return (
        F.when(month == 2, F.when(is_leap(year), 29).otherwise(28))
        .when(month.isin(4, 6, 9, 11), 30)
        .otherwise(31)
    )


def _valid_ymd(y: Column, m: Column, d: Column) -> Column:
    return (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= days_in_month(y, m))


def _mm_yy(month: Column, year: Column) -> Column:
    return F.concat(
        F.lpad(month.cast("string"), 2, "0"), F.lit("/"),
        F.lpad(F.pmod(year, F.lit(100)).cast("string"), 2, "0"),
    )


def month_number(name: Column) -> Column:
    """1-12 for a full English month name (any case), else NULL."""
    months = F.array(*[F.lit(m.lower()) for m in MONTH_NAMES])
    return F.nullif(F.array_position(months, F.lower(name)), F.lit(0)).cast("int")


def _numeric_branch(p: Column) -> Column:
    """Branches 1-6 from the split ``p`` of a text that matched ``P_NUMERIC``:
    part count and part lengths pick the branch."""
    n = F.size(p)
    a, b, c = F.get(p, 0), F.get(p, 1), F.get(p, 2)
    la, lb, lc = F.length(a), F.length(b), F.length(c)
    last2 = lambda x: F.substring(x, -2, 2)
    z2 = lambda x: F.lpad(x, 2, "0")
    slash = F.lit("/")
    return (
        F.when((n == 2) & (la <= 2) & lb.isin(2, 4), F.concat(z2(a), slash, last2(b)))
        .when((n == 1) & (la == 4), F.concat(F.lit("01/"), last2(a)))
        .when((n == 2) & (la == 4) & (lb <= 2), F.concat(z2(b), slash, last2(a)))
        .when((n == 2) & (la == 2) & (lb == 1), F.concat(z2(b), slash, a))
        .when((n == 3) & (la <= 2) & (lb <= 2) & (lc == 4), F.concat(z2(a), slash, last2(c)))
        .when((n == 3) & (la == 4) & (lb <= 2) & (lc <= 2), F.concat(z2(b), slash, last2(a)))
    )


def _textual_branch(p: Column) -> Column:
    """Branches 7-8 from the split ``p`` of a text that matched ``P_TEXTUAL``:
    full month name, a day a %d directive accepts, and a real calendar date."""
    m = month_number(F.get(p, 0))
    day_txt = F.get(p, 1)
    d = day_txt.try_cast("int")
    y = F.get(p, 2).try_cast("int")
    ok = day_txt.rlike(P_DAY) & m.isNotNull() & _valid_ymd(y, m, d)
    return F.when(ok, _mm_yy(m, y))


def _iso_branch(s: Column) -> Column:
    """Branch 9: ISO calendar date (extended or basic) or ISO week date, with an
    optional single-character separator and time; month/year are taken from
    the date as written (an offset never shifts them)."""
    ext = F.substring(s, 5, 1) == "-"
    y = F.substring(s, 1, 4).try_cast("int")
    m = F.when(ext, F.substring(s, 6, 2)).otherwise(F.substring(s, 5, 2)).try_cast("int")
    d = F.when(ext, F.substring(s, 9, 2)).otherwise(F.substring(s, 7, 2)).try_cast("int")
    cal = F.when(s.rlike(P_ISO_CAL) & _valid_ymd(y, m, d), _mm_yy(m, y))

    w = F.regexp_extract(s, r"^[0-9]{4}-?W([0-9]{2})", 1).try_cast("int")
    dow = F.coalesce(
        F.nullif(F.regexp_extract(s, r"^[0-9]{4}(?:-W[0-9]{2}-|W[0-9]{2})([1-7])", 1), F.lit(""))
        .try_cast("int"),
        F.lit(1),
    )
    safe_y = F.when(y >= 1, y).otherwise(F.lit(2000))
    jan1_wd = F.weekday(F.make_date(safe_y, F.lit(1), F.lit(1)))
    has_w53 = (jan1_wd == 3) | ((jan1_wd == 2) & is_leap(safe_y))
    jan4 = F.make_date(safe_y, F.lit(1), F.lit(4))
    day = F.date_add(F.date_sub(jan4, F.weekday(jan4)), (w - 1) * 7 + (dow - 1))
    week_ok = s.rlike(P_ISO_WEEK) & (y >= 1) & (((w >= 1) & (w <= 52)) | ((w == 53) & has_w53))
    week = F.when(week_ok, F.date_format(day, "MM/yy"))
    return F.coalesce(cal, week)


def standardize_date(raw: Column) -> Column:
    """Column form of the cascade (one expression; fine for ad-hoc use).

    Hot paths should use ``with_standardized_date``, which stages the strip
    and the splits as columns so generated code stays small.
    """
    s = ustrip(raw)
    return F.coalesce(
        F.when(s.rlike(P_NUMERIC), _numeric_branch(F.split(s, P_NUMERIC_SPLIT))),
        F.when(s.rlike(P_TEXTUAL), _textual_branch(F.split(s, P_TEXTUAL_SPLIT))),
        _iso_branch(s),
    )


def _sql_lit(text: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stage_sql(src: str) -> tuple[list[str], list[str], str]:
    """The staged cascade as SQL expressions (built once per call from the
    fixed patterns; one parse on the JVM instead of hundreds of Column calls)."""
    num, txt, cal, week = (_sql_lit(p) for p in (P_NUMERIC, P_TEXTUAL, P_ISO_CAL, P_ISO_WEEK))
    strip = _sql_lit(r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$")
    months = ", ".join(_sql_lit(m.lower()) for m in MONTH_NAMES)
    stage1 = [f"regexp_replace(`{src}`, {strip}, '') AS __date_s"]
    stage2 = [
        f"""CASE WHEN __date_s RLIKE {num} THEN 1 WHEN __date_s RLIKE {txt} THEN 2
                 WHEN __date_s RLIKE {cal} THEN 3 WHEN __date_s RLIKE {week} THEN 4 END AS __date_kind""",
    ]
    return stage1, stage2, f"""
      CASE WHEN __date_kind = 1 THEN split(__date_s, {_sql_lit(P_NUMERIC_SPLIT)})
           WHEN __date_kind = 2 THEN split(__date_s, {_sql_lit(P_TEXTUAL_SPLIT)}) END AS __date_p""" + "|" + months


def with_standardized_date(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Add ``dst`` = ``src`` normalised to ``MM/YY`` (NULL when nothing parses).

    ``src`` is the text of the value (see ``variant.python_text``). Staged so
    generated code stays small: strip once; classify the shape once (numeric,
    textual, ISO calendar, ISO week: the shapes are disjoint, and a numeric
    shape always ends in one of branches 1-6 or none); split once; derive
    year / month / day integers once; then validate and format. Written as
    SQL expressions: the same logic as the Column helpers above, built with
    one JVM call per stage.
    """
    stage1, stage2, rest = _stage_sql(src)
    split_expr, months = rest.split("|")
    day = _sql_lit(P_DAY)
    week_no = _sql_lit(r"^[0-9]{4}-?W([0-9]{2})")
    week_dow = _sql_lit(r"^[0-9]{4}(?:-W[0-9]{2}-|W[0-9]{2})([1-7])")
    cols = df.columns
    keep = [f"`{c}`" for c in cols]
    ext = "substring(__date_s, 5, 1) = '-'"
    leap = "((__date_y % 4 = 0 AND __date_y % 100 <> 0) OR __date_y % 400 = 0)"
    dim = f"CASE WHEN __date_m = 2 THEN CASE WHEN {leap} THEN 29 ELSE 28 END WHEN __date_m IN (4, 6, 9, 11) THEN 30 ELSE 31 END"
    valid = f"(__date_y >= 1 AND __date_m BETWEEN 1 AND 12 AND __date_d >= 1 AND __date_d <= {dim})"
    mm_yy = "concat(lpad(CAST({m} AS STRING), 2, '0'), '/', lpad(CAST(pmod({y}, 100) AS STRING), 2, '0'))"
    a, b, c = "get(__date_p, 0)", "get(__date_p, 1)", "get(__date_p, 2)"
    numeric = f"""CASE
        WHEN __date_n = 2 AND __date_la <= 2 AND __date_lb IN (2, 4) THEN concat(lpad({a}, 2, '0'), '/', substring({b}, -2, 2))
        WHEN __date_n = 1 AND __date_la = 4 THEN concat('01/', substring({a}, -2, 2))
        WHEN __date_n = 2 AND __date_la = 4 AND __date_lb <= 2 THEN concat(lpad({b}, 2, '0'), '/', substring({a}, -2, 2))
        WHEN __date_n = 2 AND __date_la = 2 AND __date_lb = 1 THEN concat(lpad({b}, 2, '0'), '/', {a})
        WHEN __date_n = 3 AND __date_la <= 2 AND __date_lb <= 2 AND __date_lc = 4 THEN concat(lpad({a}, 2, '0'), '/', substring({c}, -2, 2))
        WHEN __date_n = 3 AND __date_la = 4 AND __date_lb <= 2 AND __date_lc <= 2 THEN concat(lpad({b}, 2, '0'), '/', substring({a}, -2, 2))
      END"""
    jan1_wd = "pmod(weekday(__date_j4) - 3, 7)"
    week_ok = (f"(__date_j4 IS NOT NULL AND ((__date_w BETWEEN 1 AND 52) OR "
               f"(__date_w = 53 AND ({jan1_wd} = 3 OR ({jan1_wd} = 2 AND {leap})))))")
    week_day = "date_add(__date_j4, (__date_w - 1) * 7 + (__date_dow - 1) - weekday(__date_j4))"
    out = f"""CASE
        WHEN __date_kind = 1 THEN {numeric}
        WHEN __date_kind IN (2, 3) THEN CASE WHEN {valid} THEN {mm_yy.format(m='__date_m', y='__date_y')} END
        WHEN __date_kind = 4 THEN CASE WHEN {week_ok} THEN {mm_yy.format(m=f'month({week_day})', y=f'year({week_day})')} END
      END AS `{dst}`"""
    staged = df.selectExpr(*keep, *stage1)
    staged = staged.selectExpr(*keep, "__date_s", *stage2)
    staged = staged.selectExpr(*keep, "__date_s", "__date_kind", split_expr)
    staged = staged.selectExpr(
        *keep, "__date_s", "__date_kind", "__date_p",
        "CASE WHEN __date_kind = 1 THEN size(__date_p) END AS __date_n",
        f"CASE WHEN __date_kind = 1 THEN length({a}) END AS __date_la",
        f"CASE WHEN __date_kind = 1 THEN length({b}) END AS __date_lb",
        f"CASE WHEN __date_kind = 1 THEN length({c}) END AS __date_lc",
        f"""CASE WHEN __date_kind = 2 THEN try_cast({c} AS INT)
                 WHEN __date_kind >= 3 THEN try_cast(substring(__date_s, 1, 4) AS INT) END AS __date_y""",
        f"""CASE WHEN __date_kind = 2 THEN nullif(array_position(array({months}), lower({a})), 0)
                 WHEN __date_kind = 3 THEN try_cast(CASE WHEN {ext} THEN substring(__date_s, 6, 2)
                                                        ELSE substring(__date_s, 5, 2) END AS INT) END AS __date_m""",
        f"""CASE WHEN __date_kind = 2 THEN CASE WHEN {b} RLIKE {day} THEN try_cast({b} AS INT) END
                 WHEN __date_kind = 3 THEN try_cast(CASE WHEN {ext} THEN substring(__date_s, 9, 2)
                                                        ELSE substring(__date_s, 7, 2) END AS INT) END AS __date_d""",
        f"CASE WHEN __date_kind = 4 THEN try_cast(regexp_extract(__date_s, {week_no}, 1) AS INT) END AS __date_w",
        f"""CASE WHEN __date_kind = 4 THEN coalesce(try_cast(regexp_extract(__date_s, {week_dow}, 1) AS INT), 1)
            END AS __date_dow""",
    )
    staged = staged.selectExpr(
        "*", "CASE WHEN __date_kind = 4 AND __date_y >= 1 THEN make_date(__date_y, 1, 4) END AS __date_j4")
    return staged.selectExpr(*keep, out)
