"""Cleaning and derivation expressions K1–K21.

The reference implements these as scalar T-SQL functions with row loops.
Here each one is a plain Column expression (regexp_replace, try_cast,
higher-order functions), so it runs inside whole-stage codegen over whole
columns; no Python UDF is involved.

String comparisons in the reference are case- and accent-insensitive; the
rules below lower-case or upper-case before comparing where that matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NBSP = "\u00a0"

# A plain decimal literal: what TRY_CONVERT(DECIMAL) accepts (no exponent).
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: Column | str) -> Column:
    """LTRIM/RTRIM: spaces only (tabs and NBSP stay) - Spark's trim does
    exactly that, without a regex."""
    return F.trim(_c(c))


def try_decimal(text: Column, precision: int, scale: int) -> Column:
    """TRY_CONVERT(DECIMAL(p,s), text): NULL unless a plain decimal literal
    (Spark's try_cast would also accept exponents such as '1e3')."""
    return F.when(text.rlike(DECIMAL_TEXT), text).try_cast(f"decimal({precision},{scale})")


# ------------------------------------------------------------------ K1
def clean_text(c: Column | str, max_len: int | None = None) -> Column:
    """K1: NULL -> ''; trim spaces; cut to max_len; '' -> NULL."""
    t = trim_spaces(F.coalesce(_c(c), F.lit("")))
    if max_len:
        t = F.substring(t, 1, max_len)
    return F.nullif(t, F.lit(""))


# ------------------------------------------------------------------ K2
def to_decimal(c: Column | str) -> Column:
    """K2: trim; drop NBSP and spaces; ',' -> '.'; DECIMAL(10,2) or NULL."""
    t = trim_spaces(_c(c))
    t = F.regexp_replace(t, f"[{NBSP} ]", "")
    t = F.translate(t, ",", ".")
    return try_decimal(t, 10, 2)


# ------------------------------------------------------------------ K3
def staged(df: DataFrame, steps: list[tuple[str, Column]], out: str, result: Column) -> DataFrame:
    """Add ``steps`` as temporary columns one after another, then ``out``.

    A rule that reuses an intermediate value several times, written as one
    nested Column, repeats that sub-tree at every use; the generated code
    then passes the JVM's 64 KB method limit and Spark falls back to
    interpreted evaluation. As separate projections each step is computed
    once (the optimizer does not inline a non-trivial expression that is
    used more than once) and the whole chain stays in one codegen stage.
    """
    for name, expr in steps:
        df = df.withColumn(name, expr)
    return df.withColumn(out, result).drop(*[n for n, _ in steps])


def amount_flexible_on(src: str, out: str):
    """K3: flexible amount; the last separator is the decimal point.

    NBSP, 'ARS' (any case), '$', spaces and tabs removed; '(x)' -> '-x';
    only digits . , - kept; a leading '-' is the sign, other '-' dropped;
    no separator -> integer; else left and right of the last separator with
    all separators removed. DECIMAL(18,2) or NULL.
    """
    s, t, u, v = F.col(src), F.col("_k3_t"), F.col("_k3_u"), F.col("_k3_v")
    sign, pos = F.col("_k3_sign"), F.col("_k3_pos")
    left, right = F.col("_k3_l"), F.col("_k3_r")
    rv = F.reverse(v)
    last_sep = F.least(F.when(F.instr(rv, ".") > 0, F.instr(rv, ".")),
                       F.when(F.instr(rv, ",") > 0, F.instr(rv, ",")))
    # Letters are dropped later anyway, so upper-casing first only makes the
    # 'ARS' removal case-insensitive, as the reference's collation does.
    steps = [
        ("_k3_t", F.translate(F.replace(F.upper(F.translate(s, NBSP, " ")), F.lit("ARS"), F.lit("")), "$ \t", "")),
        ("_k3_t", F.when(t.startswith("(") & t.endswith(")") & (F.length(t) >= 2),
                         F.concat(F.lit("-"), t.substr(F.lit(2), F.length(t) - 2))).otherwise(t)),
        ("_k3_u", F.regexp_replace(t, "[^0-9.,-]", "")),
        ("_k3_sign", F.when(u.startswith("-"), F.lit("-")).otherwise(F.lit(""))),
        ("_k3_v", F.translate(u, "-", "")),
        ("_k3_pos", F.length(v) - last_sep + 1),
        ("_k3_l", F.translate(F.substring(v, F.lit(1), pos - 1), ".,", "")),
        ("_k3_r", F.translate(v.substr(pos + 1, F.length(v)), ".,", "")),
    ]
    normalized = F.concat(sign, F.when(left == "", F.lit("0")).otherwise(left), F.lit("."), right)
    result = (F.when(s.isNull() | (trim_spaces(s) == ""), F.lit(None))
              .when(u == "", F.lit(None))
              .when(pos.isNull(), try_decimal(F.concat(sign, v), 18, 2))
              .otherwise(try_decimal(normalized, 18, 2))).cast("decimal(18,2)")
    return lambda df: staged(df, steps, out, result)


# ------------------------------------------------------------------ K4
def amount_candidates_on(src: str, out: str):
    """K4: the payment loader's amount parse (kept with its defect).

    Candidates: comma-decimal, point-decimal, no separators. The "two
    decimals" test counts the characters LEFT of the last point, so local
    formats are misread ("12.345,67" -> 12.35). DECIMAL(12,2).
    """
    v0, v2 = F.col("_k4_v0"), F.col("_k4_v2")
    cc, cp, cs, neg = F.col("_k4_cc"), F.col("_k4_cp"), F.col("_k4_cs"), F.col("_k4_neg")

    def left_of_last_dot(x: Column) -> Column:
        return F.when(F.instr(x, ".") > 0, F.length(x) - F.instr(F.reverse(x), "."))

    def conv(x: Column) -> Column:
        return try_decimal(F.concat(F.when(neg, F.lit("-")).otherwise(F.lit("")), x), 12, 2)

    steps = [
        # removals in the reference's order; upper first = its case-insensitive REPLACE
        ("_k4_v0", trim_spaces(F.translate(
            F.replace(F.replace(F.replace(F.replace(
                F.upper(F.translate(F.col(src), NBSP + "\t", "  ")),
                F.lit("AR$"), F.lit("")), F.lit("ARS"), F.lit("")), F.lit("U$S"), F.lit("")), F.lit("$"), F.lit("")),
            '"', ""))),
        ("_k4_neg", v0.startswith("(") & v0.endswith(")")),
        ("_k4_v2", F.translate(v0, "() ", "")),
        ("_k4_cc", F.translate(v2, ",.", ".")),
        ("_k4_cp", F.translate(v2, ",", "")),
        ("_k4_cs", F.translate(v2, ".,", "")),
    ]
    result = F.coalesce(F.when(left_of_last_dot(cp) == 2, conv(cp)),
                        F.when(left_of_last_dot(cc) == 2, conv(cc)),
                        conv(cp), conv(cc), conv(cs))
    return lambda df: staged(df, steps, out, result)


# ------------------------------------------------------------------ K5
# Typo fixes of the email normaliser, applied in this order.
EMAIL_FIXES = [
    ("gmailcom", "gmail.com"),
    ("hotmailcom", "hotmail.com"),
    ("outlookcom", "outlook.com"),
    ("yahoocom", "yahoo.com"),
    ("livecom", "live.com"),
    ("gmailcon", "gmail.com"),
    ("gmailvom", "gmail.com"),
    ("gmail.comar", "gmail.com.ar"),
    ("hotmail.comar", "hotmail.com.ar"),
    ("outlook.comar", "outlook.com.ar"),
    ("(at)", "@"),
    (" arroba ", "@"),
    (" arroba", "@"),
    ("arroba ", "@"),
]


def email_normalise(c: Column | str) -> Column:
    """K5: trim, NBSP -> space, lower, drop tab/CR/LF, ',' ';' -> '.', remove
    spaces around '@' and then all spaces, then the typo fixes in order.
    The 'arroba' fixes contain spaces and run after all spaces are gone, so
    they never match (kept as in the reference)."""
    e = trim_spaces(F.coalesce(_c(c), F.lit("")))
    e = F.lower(F.regexp_replace(e, NBSP, " "))
    e = F.regexp_replace(e, "[\t\n\r]", "")
    e = F.translate(e, ",;", "..")
    e = F.replace(e, F.lit(" @ "), F.lit("@"))
    e = F.replace(e, F.lit(" @"), F.lit("@"))
    e = F.replace(e, F.lit("@ "), F.lit("@"))
    e = F.replace(e, F.lit(" "), F.lit(""))
    for old, new in EMAIL_FIXES:
        e = F.replace(e, F.lit(old), F.lit(new))
    return trim_spaces(e)


# ------------------------------------------------------------------ K6
def email_valid_on(src: str, out: str):
    """K6: full e-mail validity flag (1/0), rule by rule as in the reference.
    Labels are checked on their first 63 characters and the TLD on its first
    24 (the reference's variables truncate), so those length limits never fire."""
    e, local, domain, tld24 = F.col("_k6_e"), F.col("_k6_l"), F.col("_k6_d"), F.col("_k6_t")
    steps = [
        ("_k6_e", F.regexp_replace(trim_spaces(F.coalesce(F.col(src), F.lit(""))), NBSP, " ")),
        ("_k6_l", F.substring_index(e, "@", 1)),
        ("_k6_d", e.substr(F.instr(e, "@") + 1, F.length(e))),
        ("_k6_t", F.substring(F.regexp_extract(domain, r"([^.]*)$", 1), 1, 24)),
    ]
    ok = ((e != "")
          & ~e.rlike("[\t\n\r ]")
          & ~e.startswith(".") & ~e.endswith(".") & ~e.contains("..")
          & (F.length(e) - F.length(F.regexp_replace(e, "@", "")) == 1)
          & (F.length(e) <= 254)
          & (F.length(local) >= 1) & (F.length(local) <= 64)
          & (F.length(domain) >= 1) & (F.length(domain) <= 255)
          & local.rlike("^[-0-9A-Za-z._+]+$")
          & ~local.startswith(".") & ~local.endswith(".") & ~local.contains("..")
          & domain.contains(".")
          & domain.rlike("^[-0-9A-Za-z.]+$")
          & ~domain.rlike(r"^[.-]|[.-]$")
          & ~domain.contains("..") & ~domain.contains(".-") & ~domain.contains("-.")
          & F.forall(F.split(domain, r"\.", -1), lambda lb: (F.length(lb) >= 1)
                     & ~F.substring(lb, 1, 63).startswith("-") & ~F.substring(lb, 1, 63).endswith("-"))
          & (F.length(tld24) >= 2) & tld24.rlike("^[A-Za-z]+$"))
    return lambda df: staged(df, steps, out, F.when(ok, 1).otherwise(0))


def email_light(c: Column | str) -> Column:
    """Normalised e-mail kept only if it has '@' and a later '.'; cut to 255."""
    e = F.nullif(email_normalise(c), F.lit(""))
    return F.when(e.rlike(r"@.*\."), F.substring(e, 1, 255))


# ------------------------------------------------------------------ K7
def cbu_strict(c: Column | str) -> Column:
    """K7: remove space - . / \\ _ ( ) tab NBSP; the 22-digit id or NULL."""
    t = F.regexp_replace(trim_spaces(_c(c)), r"[ \-./\\_()\t" + NBSP + "]", "")
    return F.when(t.rlike("^[0-9]{22}$"), t)


def cbu_padded(c: Column | str) -> Column:
    """Upper, remove NBSP tab space . -, left-pad with zeros keeping the
    RIGHT 22 characters (all zeros = rejected by the loader)."""
    t = F.translate(F.upper(trim_spaces(_c(c))), NBSP + "\t .-", "")
    return F.substring(F.concat(F.lit("0" * 22), t), -22, 22)


# ----------------------------------------------------------- K15 – K21
# Spanish month names (the reference accepts no 'setiembre').
MONTHS_ES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
             "septiembre", "octubre", "noviembre", "diciembre"]


def month_number(c: Column | str) -> Column:
    """Spanish month name -> 1..12; 'mayo' matched as a prefix after
    removing spaces; unknown -> NULL."""
    raw = _c(c)
    name = F.lower(trim_spaces(raw))
    e = None
    for i, m in enumerate(MONTHS_ES, start=1):
        cond = F.lower(F.regexp_replace(raw, " ", "")).startswith("mayo") if m == "mayo" else (name == m)
        e = F.when(cond, F.lit(i)) if e is None else e.when(cond, F.lit(i))
    return e


def floor_number(c: Column | str) -> Column:
    """PB, P.B, P.B., PLANTA BAJA -> 0; else a TINYINT (0..255) or NULL."""
    t = trim_spaces(_c(c))
    n = F.when(t.rlike("^[+-]?[0-9]+$"), t).try_cast("int")
    return (F.when(F.upper(t).isin("PB", "P.B", "P.B.", "PLANTA BAJA"), F.lit(0))
            .otherwise(F.when((n >= 0) & (n <= 255), n))).cast("int")


def department(c: Column | str) -> Column:
    """First character of the trimmed department, NULL when blank."""
    t = F.nullif(trim_spaces(_c(c)), F.lit(""))
    return F.substring(t, 1, 1)


# Tenant flag words.
TENANT_YES = ["si", "sí", "true", "1", "inquilino"]
TENANT_NO = ["no", "false", "0", "propietario"]


def tenant_flag(c: Column | str) -> Column:
    """1 / 0 / NULL (NULL rows are dropped by the loader)."""
    t = F.lower(trim_spaces(_c(c)))
    return F.when(t.isin(*TENANT_YES), 1).when(t.isin(*TENANT_NO), 0)


def phone(c: Column | str) -> Column:
    """Remove space - ( ); '' -> NULL; cut to 50."""
    t = F.nullif(F.regexp_replace(_c(c), r"[ \-()]", ""), F.lit(""))
    return F.substring(t, 1, 50)


def parse_date(c: Column | str) -> Column:
    """dd/mm/yyyy, then yyyy-mm-dd, then yyyymmdd; invalid -> NULL."""
    t = F.nullif(trim_spaces(_c(c)), F.lit(""))
    return F.coalesce(F.when(t.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_date(t, "d/M/yyyy")),
                      F.when(t.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_date(t, "yyyy-M-d")),
                      F.when(t.rlike(r"^[0-9]{8}$"), F.try_to_date(t, "yyyyMMdd")))


def clamp_amount(c: Column | str) -> Column:
    """Clamp to +-99,999,999.99 and cast to DECIMAL(10,2)."""
    lim = F.lit(99999999.99).cast("decimal(10,2)")
    return F.least(F.greatest(_c(c), -lim), lim).cast("decimal(10,2)")


def due_day(year: Column, month: Column, day: Column | None) -> Column:
    """make_date with the day clamped to the month length; NULL day ->
    month end."""
    first = F.make_date(year, month, F.lit(1))
    last = F.last_day(first)
    if day is None:
        return last
    return F.when(day.isNull(), last).otherwise(
        F.make_date(year, month, F.least(day, F.dayofmonth(last))))
