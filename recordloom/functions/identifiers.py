"""Identifiers out of free text, urls and links, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The DOI form, the host that resolves DOIs, the work id prefix.
DOI_PATTERN = r"""(?U)\b(10[.][0-9]{4,}(?:[.][0-9]+)*/[^\s"&'<>]+)\b"""
DOI_HOST = "doi.org"
WORK_ID_PREFIX = "https://openalex.org/"

_HIDDEN_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_ANCHOR_HREF = r"""(?is)<a\s(?:(?:[^>"']|"[^"]*"|'[^']*')*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    An expression used inside a lambda is evaluated for every element; a
    lambda variable is not. The value is the start of a fold over nothing,
    whose last step is ``body``: a function of a column or a SQL lambda as text.
    """
    nothing = F.array().cast("array<int>")
    if isinstance(body, str):
        return F.call_function("aggregate", nothing, value, F.expr("(v, x) -> v"), F.expr(body))
    return F.aggregate(nothing, value, lambda v, x: v, body)


def is_blank(c: Column | str) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(_col(c).cast("string"), F.lit("")) == ""


def extract_doi(c: Column | str) -> Column:
    """First DOI in a text, upper-cased; ``""`` when there is none."""
    return F.coalesce(F.upper(F.regexp_extract(_col(c), DOI_PATTERN, 1)), F.lit(""))


def doi_from_url(c: Column | str) -> Column:
    """First DOI in a url as written there, from its first digit on."""
    found = F.regexp_extract(_col(c), DOI_PATTERN, 1)
    return F.coalesce(F.regexp_extract(found, r"[0-9].*", 0), F.lit(""))


def page_links(html: Column | str) -> Column:
    """Link targets of a page in document order, without those in comments."""
    visible = F.regexp_replace(_col(html), _HIDDEN_MARKUP, "")
    quoted = F.regexp_extract_all(visible, F.lit(_ANCHOR_HREF), F.lit(1))
    return F.transform(quoted, lambda x: F.regexp_replace(x, r"""^["']|["']$""", ""))


def doi_link(html: Column | str) -> Column:
    """First link of a page that names the DOI host; null if no link does."""
    html = _col(html)
    link = F.get(F.filter(page_links(html), lambda x: x.contains(DOI_HOST)), F.lit(0))
    # Numeric entities of ASCII characters, then the named ones.
    numbers = F.regexp_extract_all(link, F.lit("(?i)&#(x0*[0-7]?[0-9a-f]|0*[0-9]{1,2}|0*1[01][0-9]|0*12[0-7]);"), F.lit(1))

    def plain_char(number: Column) -> Column:
        hexed = F.lower(number).startswith("x")
        code = F.when(hexed, F.conv(F.substring(number, 2, 99), 16, 10)).otherwise(number)
        return F.char(code.cast("int"))

    link = F.aggregate(
        numbers, link, lambda text, n: F.replace(text, F.concat(F.lit("&#"), n, F.lit(";")), plain_char(n))
    )
    for entity, plain in _ENTITIES:
        link = F.replace(link, F.lit(entity), F.lit(plain))
    # The substring test spares most pages the two regular expressions.
    return F.when(html.contains(DOI_HOST), link)


def doi_of_link(url: Column | str, link: Column | str) -> Column:
    """DOI of a page from its DOI link, else from its url, else ``""``.

    A link that names the host without a path is an error in the page and
    gives ``""``; an empty path falls back to the url.
    """
    url, link = _col(url), _col(link)
    path = F.get(F.split(link, DOI_HOST.replace(".", "[.]") + "/"), F.lit(1))
    return (
        F.when(link.isNull() | (path == ""), doi_from_url(url))
        .otherwise(F.coalesce(path, F.lit("")))
    )


def extract_work_id(c: Column | str) -> Column:
    """Work id behind the service prefix: ``""`` for null, null without prefix."""
    c = _col(c)
    at = F.locate(WORK_ID_PREFIX, c)
    return (
        F.when(c.isNull(), F.lit(""))
        .when(at > 0, F.substring(c, at + len(WORK_ID_PREFIX), F.length(c)))
    )


def bad_work_id(c: Column | str) -> Column:
    """True for a text that is not a work id url."""
    c = _col(c)
    return F.coalesce(~c.contains(WORK_ID_PREFIX), F.lit(False))


def to_key(c: Column | str) -> Column:
    """Integer key of a number or numeric text, null for anything else."""
    c = _col(c)
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
