"""Token and headline expressions (native Columns + DuckDB twins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
# Headline stop words excluded from keyword counts (tokens are >= 5 chars).
STOPWORDS = (
    "about", "after", "their", "these", "those", "which", "where", "there",
    "would", "could", "should", "being", "until", "while", "among", "other",
    "first", "years", "today", "sagte", "wurde", "haben", "dieser", "einer",
    "sopra", "dopo", "prima", "dalla", "contro", "degli",
)
MIN_TOKEN_LEN = 5
# Stub headlines dropped by the cleaner (straight and curly apostrophe).
STUB_TITLES = ("Here's the latest.", "Here’s the latest.")
# ---------------------------------------------------------------------------

# POSIX [[:alnum:]] of the reference is ASCII-only; Java needs \p{Alnum}.
ASCII_SPLIT = r"[^\p{Alnum}]+"
ASCII_SPLIT_SQL = "[^[:alnum:]]+"
UNICODE_SPLIT = r"(?U)[^\p{Alnum}]+"
UNICODE_SPLIT_SQL = r"[^\p{L}\p{N}]+"


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def tokens(title: Column, unicode: bool = False) -> Column:
    """Lower-cased keyword tokens of a headline: split on non-alphanumerics,
    keep length >= 5 and not a stop word. Filtering happens on the array so
    rows are only multiplied by the tokens that survive."""
    parts = F.split(title, UNICODE_SPLIT if unicode else ASCII_SPLIT)
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.filter(
        F.transform(parts, lambda t: F.lower(t)),
        lambda t: (F.length(t) >= MIN_TOKEN_LEN) & ~F.array_contains(stop, t),
    )


def headline(text: Column) -> Column:
    """First sentence-ish run of a document: everything before the first '.' or newline."""
    return F.regexp_extract(text, r"^[^.\n]*", 0)


def clean_title(title: Column) -> Column:
    return F.nullif(F.regexp_replace(title, r"^\s+|\s+$", ""), F.lit(""))


def is_stub(title: Column) -> Column:
    return title.isin(*STUB_TITLES)


# --------------------------------------------------------------- DuckDB twins
def headline_sql(x: str) -> str:
    return f"regexp_extract({x}, '^[^.\\n]*', 0)"


def clean_title_sql(x: str) -> str:
    return f"nullif(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '')"


def explode_tokens(df, keep: list[str], title: str = "title", unicode: bool = False):
    """One row per keyword token of ``title`` (same rule as ``tokens``), with
    the ``keep`` columns. Exploding first and filtering rows keeps the work in
    generated code (array lambdas are evaluated without codegen)."""
    raw = df.select(*keep, F.explode(F.split(F.col(title), UNICODE_SPLIT if unicode else ASCII_SPLIT)).alias("_t"))
    tok = F.lower(F.col("_t"))
    return (raw.select(*keep, tok.alias("token"))
               .filter((F.length("token") >= MIN_TOKEN_LEN) & ~F.col("token").isin(*STOPWORDS)))
