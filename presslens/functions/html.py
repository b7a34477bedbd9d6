"""HTML text expressions as native Spark Columns.

Visible text needs no element stack: the text nodes between tags, without the
elements that hold raw text. These are regex chains in the subset that both Java
regex and RE2 accept. The main text of a page depends on nesting and is found by
a stack of open elements (``body_text``).
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
# Elements whose text is never visible text.
INVISIBLE_TAGS = ("script", "style", "noscript", "template")
# ---------------------------------------------------------------------------

# All named character references that end in a semicolon; a no-break space is a space in text.
NAMED = {name[:-1]: chars.replace("\xa0", " ") for name, chars in html5.items() if name.endswith(";")}
# looked up before the whole table, which is searched from end to end
COMMON = ("amp", "lt", "gt", "quot", "apos", "nbsp", "hellip", "ndash", "mdash", "lsquo", "rsquo", "ldquo", "rdquo", "copy", "euro")
# what may follow an '&': a name with its semicolon, a number, or one of the old names that need none
NAME_RE = r"^([A-Za-z][A-Za-z0-9]*);"
NUMBER_RE = r"^#([0-9]{1,18}|[xX][0-9A-Fa-f]{1,15});?"
OLD_RE = "^(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"
# numbers 128 to 159 mean the characters of Windows' Latin code page, where it has one
CONTROLS = "".join(map(chr, range(128, 160)))
WINDOWS = "".join(bytes([i]).decode("cp1252") if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(i) for i in range(128, 160))

TAG_RE = r"<[A-Za-z/!?][^>]*>"
SPACES = " \t\n\x0b\f\r"


# One alternation, so one pass over the text (leftmost match wins, as in a
# browser); one branch per tag, as RE2 has no back-references.
HIDDEN_RE = "(?is)<!--.*?-->|" + "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in INVISIBLE_TAGS)


def decode_entities(c: Column) -> Column:
    """One level of character references (named, decimal, hexadecimal) decoded; anything else after '&' stays.

    A name that is none with its semicolon may begin with an old name that needs
    none. The text is cut at each '&', so that it occurs once in the plan and is
    evaluated once.
    """
    def table(names) -> Column:
        # one literal, folded into a map when the query is planned
        return F.str_to_map(F.lit("\x01".join(f"{n}\x02{NAMED[n]}" for n in names)), F.lit("\x01"), F.lit("\x02"))

    def named(name: Column) -> Column:
        return F.coalesce(F.try_element_at(table(COMMON), name), F.try_element_at(table(NAMED), name))

    def after(piece: Column, reference: Column) -> Column:
        rest = F.substr(piece, F.length(reference) + 1)
        return F.when(rest.startswith(";"), F.substr(rest, F.lit(2))).otherwise(rest)

    def decoded(piece: Column) -> Column:
        name, digits, old = (F.regexp_extract(piece, r, 1) for r in (NAME_RE, NUMBER_RE, OLD_RE))
        number = F.when(F.lower(digits).startswith("x"), F.conv(F.substr(digits, F.lit(2)), 16, 10)).otherwise(digits).try_cast("long")
        char = F.when(number == 160, " ").when(
            (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF), "\ufffd").otherwise(
            F.translate(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"), CONTROLS, WINDOWS))
        return (
            F.when(name != "", F.concat(named(name), after(piece, name)))
            .when(digits != "", F.concat(char, after(piece, F.concat(F.lit("#"), digits))))
        ), F.concat(named(old), F.substr(piece, F.length(old) + 1)), F.concat(F.lit("&"), piece)

    pieces = F.transform(F.split(c, "&"), lambda piece, i: F.when(i == 0, piece).otherwise(F.coalesce(*decoded(piece))))
    return F.array_join(pieces, "")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def decode_entities_sql(x: str) -> str:
    """The same, for DuckDB."""
    name, digits, old = (f"regexp_extract(p, {_q(r)}, 1)" for r in (NAME_RE, NUMBER_RE, OLD_RE))
    number = (f"CASE WHEN lower({digits}) LIKE 'x%' THEN TRY_CAST('0x' || substr({digits}, 2) AS BIGINT) "
              f"ELSE TRY_CAST({digits} AS BIGINT) END")
    table = "MAP {" + ", ".join(f"{_q(n)}: {_q(c)}" for n, c in NAMED.items()) + "}"
    char = (f"CASE WHEN ({number}) = 160 THEN ' ' WHEN ({number}) = 0 OR ({number}) > 1114111 OR ({number}) BETWEEN 55296 AND 57343 "
            f"THEN '\ufffd' ELSE translate(chr(({number})::INTEGER), {_q(CONTROLS)}, {_q(WINDOWS)}) END")
    decoded = (f"coalesce(map_extract({table}, nullif({name}, ''))[1] || substr(p, length({name}) + 2), "
               f"CASE WHEN {digits} <> '' THEN ({char}) || regexp_replace(p, {_q(NUMBER_RE)}, '') END, "
               f"map_extract({table}, nullif({old}, ''))[1] || substr(p, length({old}) + 1), '&' || p)")
    return (f"array_to_string(list_transform(string_split({x}, '&'), "
            f"lambda p, i: CASE WHEN i = 1 THEN p ELSE {decoded} END), '')")


# ----------------------------------------------------------------- Spark side
def strip_html(value: Column) -> Column:
    """Visible text of an HTML fragment, text nodes decoded, trimmed and joined by one
    space, then decoded once more; NULL for NULL/empty/whitespace-only results."""
    # a split at each tag needs no repeated group, which Java would recurse into
    nodes = F.transform(F.split(value, HIDDEN_RE + "|" + TAG_RE), lambda t: F.btrim(decode_entities(t), F.lit(SPACES)))
    text = F.array_join(F.filter(nodes, lambda t: t != ""), " ")
    text = F.regexp_replace(decode_entities(text), r"^\s+|\s+$", "")
    # nullif keeps one copy of the chain in the plan (Spark 4 rewrites it with a
    # shared common expression); when(x != '', x) would evaluate it twice
    return F.nullif(text, F.lit(""))


def html_title(html: Column) -> Column:
    return strip_html(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def meta_description(html: Column) -> Column:
    """<meta name="description"> content (trimmed), else og:description; NULL if neither."""
    def meta(attr: str, name: str) -> Column:
        a = F.regexp_extract(
            html, rf"(?is)<meta\b[^>]*\b{attr}\s*=\s*[\"']{name}[\"'][^>]*\bcontent\s*=\s*[\"']([^\"']*)[\"']", 1)
        b = F.regexp_extract(
            html, rf"(?is)<meta\b[^>]*\bcontent\s*=\s*[\"']([^\"']*)[\"'][^>]*\b{attr}\s*=\s*[\"']{name}[\"']", 1)
        v = F.regexp_replace(F.coalesce(F.nullif(a, F.lit("")), b), r"^\s+|\s+$", "")
        return F.nullif(v, F.lit(""))
    return F.coalesce(meta("name", "description"), meta("property", "og:description"))


# --------------------------------------------------------------- DuckDB twins
def strip_html_sql(x: str) -> str:
    """Collects the text nodes where Spark cuts the tags away."""
    # what is hidden, a tag, or a text node (a '<' that begins no tag is text)
    piece = HIDDEN_RE + "|" + TAG_RE + "|(?:[^<]|<[^A-Za-z/!?]|<$)+"
    decoded = f"trim({decode_entities_sql('t')}, {_q(SPACES)})"
    texts = f"[{decoded} FOR t IN regexp_extract_all({x}, {_q(piece)}) IF NOT regexp_matches(t, '^<[A-Za-z/!?]')]"
    text = f"array_to_string([t FOR t IN {texts} IF t <> ''], ' ')"
    return f"nullif(regexp_replace({decode_entities_sql(text)}, '^\\s+|\\s+$', '', 'g'), '')"


def html_title_sql(x: str) -> str:
    return strip_html_sql(f"regexp_extract({x}, '(?is)<title[^>]*>(.*?)</title>', 1)")
