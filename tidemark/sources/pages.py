"""Rows out of HTML pages: listing items, declared totals, links, catalogues, product numbers."""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as V
from tidemark.functions.text import (
    blank, digits_only, extract_code, first_match, squeeze_spaces, status_from_stock)
from tidemark.functions.urls import absolute_url, clean_url, slug_from_url
from tidemark.operators.items import first_per_key
from tidemark.sources import html_nodes
from tidemark.sources.rowwise import expand_text

_ANCHOR = r"(?is)<a\b([^>]*)>(.*?)</a>"
_ANCHOR_OPEN = r"(?is)<a\b([^>]*)>"
_HREF = r"""(?is)(?:^|\s)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_ITEM_COUNT = r"""(?is)<(\w+)\b[^>]*\bid\s*=\s*["']?itemCount\b["']?[^>]*>(.*?)</\1\s*>"""
_COMMENT = r"(?s)<!--.*?-->"
_NUMERIC = r"&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"

_ITEM_OUT = T.StructType([
    T.StructField("pos", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("grade", T.StringType()), T.StructField("price_text", T.StringType()),
    T.StructField("stock", T.StringType()), T.StructField("closed", T.BooleanType()),
    T.StructField("image", T.StringType())])


_NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&yen;", "¥"),
          ("&euro;", "€"), ("&pound;", "£"), ("&copy;", "©"), ("&reg;", "®"), ("&times;", "×"), ("&middot;", "·"),
          ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"), ("&laquo;", "«"), ("&raquo;", "»"), ("&deg;", "°"),
          ("&amp;", "&"))


def _character(code: Column) -> Column:
    """Character of a decimal or x-hexadecimal number; U+FFFD where there is none."""
    hexadecimal = F.lower(F.substring(code, 1, 1)) == "x"
    number = F.when(hexadecimal, F.conv(F.substr(code, F.lit(2)), 16, 10)).otherwise(code).cast("bigint")
    bad = (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    point = F.when(bad, F.lit(0xFFFD)).otherwise(number)
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def decode_entities(c: Column) -> Column:
    """Numeric entities and the common named ones as characters; each is decoded once."""
    codes = F.transform(F.regexp_extract_all(c, F.lit(_NUMERIC), F.lit(1)), _character)
    around = F.split(c, _NUMERIC, -1)
    rests = F.slice(around, 2, F.greatest(F.size(around) - 1, F.lit(0)))
    # an ampersand by number must not start a named entity
    joined = F.zip_with(codes, rests, lambda x, rest: F.concat(F.when(x == "&", F.lit("&amp;")).otherwise(x), rest))
    c = F.when(F.contains(c, F.lit("&#")), F.concat(F.get(around, F.lit(0)), F.array_join(joined, ""))).otherwise(c)
    for entity, char in _NAMED:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def page_text(html: Column | str) -> Column:
    """Visible text of a page: scripts, styles, comments and tags out, spaces squeezed."""
    body = F.regexp_replace(blank(html), r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    body = decode_entities(F.regexp_replace(body, r"(?s)<[^>]*>", " "))
    return squeeze_spaces(body)


def extract_listing_items(pages: DataFrame, base: str, html: str = "html", page: str = "page") -> DataFrame:
    """Items of listing pages: page, pos, name, grade, price, stock, accept_status, image_url.

    ``#cardList`` is read, or ``#listView`` without one, never both.
    """
    found = expand_text(pages.withColumnRenamed(page, "page") if page != "page" else pages,
                        html, ["page"], _ITEM_OUT, html_nodes.listing)
    items = found.select(
        "page", "pos", "name", "grade", digits_only("price_text").alias("price"), "stock",
        status_from_stock("stock", "closed").alias("accept_status"),
        clean_url("image", base).alias("image_url"))
    return items.filter((F.col("name") != "") | (F.col("price") != ""))


def declared_count(html: Column | str) -> Column:
    """Number in the text of the ``#itemCount`` element, null without one."""
    inner = F.regexp_replace(F.regexp_extract(blank(html), _ITEM_COUNT, 2), "<[^>]*>", "")
    return digits_only(decode_entities(inner)).try_cast("bigint")


def _uncommented(html: Column | str) -> Column:
    return F.regexp_replace(blank(html), _COMMENT, " ")


def _href_of(attrs: Column) -> Column:
    return decode_entities(F.concat(*[F.regexp_extract(attrs, _HREF, k) for k in (1, 2, 3)]))


def hrefs(html: Column | str) -> Column:
    """All link targets of a page in document order; comments hold none."""
    opened = F.regexp_extract_all(_uncommented(html), F.lit(_ANCHOR_OPEN), F.lit(1))
    return F.filter(F.transform(opened, _href_of), lambda h: h != "")


def _matching(links: Column, pattern: str) -> Column:
    return F.filter(links, lambda h: h.rlike(pattern))


def first_link(html: Column | str, url_patterns: Sequence[str], origin: str) -> Column:
    """Absolute form of the first link of the first pattern that any link matches, null without one.

    Patterns are in order of preference: a link of an earlier one wins wherever it stands.
    """
    links = hrefs(html)
    hit = F.coalesce(*[F.get(_matching(links, p), F.lit(0)) for p in url_patterns])
    return F.when(hit.isNotNull(), absolute_url(hit, origin))


def extract_links(pages: DataFrame, url_patterns: Sequence[str], origin: str,
                  page: str = "page", html: str = "html") -> DataFrame:
    """One product link per page."""
    return pages.select(page, first_link(html, url_patterns, origin).alias("link"))


def extract_selected_links(pages: DataFrame, selectors: Sequence[tuple[str, str]], url_patterns: Sequence[str], origin: str,
                           page: str = "page", html: str = "html") -> DataFrame:
    """One product link per page: page, link (absolute, null without one).

    ``selectors`` are (class part of an element around the link, part of its href), in order of preference. Each looks at its
    first link only, which counts if any pattern matches it. If none counts, the first link of the page that any pattern
    matches is taken. Only pages that the selectors by href leave open and that name one of the classes are parsed.
    """
    product = lambda h: functools.reduce(Column.__or__, [h.rlike(p) for p in url_patterns])
    by_href = list(itertools.takewhile(lambda s: not s[0], selectors))
    rest = list(selectors[len(by_href):])
    classes = list(dict.fromkeys(within for within, _ in rest if within))
    links = F.col("_links")
    first = lambda part: F.get(F.filter(links, lambda h: F.contains(h, F.lit(part))), F.lit(0))
    checked = lambda h: F.when(product(h), h)
    read = pages.select(page, html, hrefs(html).alias("_links"))
    early = F.coalesce(*[checked(first(part)) for _, part in by_href], F.lit(None).cast("string"))
    read = read.select(page, html, "_links", early.alias("_early"))
    named = functools.reduce(Column.__or__, [F.contains(blank(html), F.lit(c)) for c in classes], F.lit(False))
    asked = F.col("_early").isNull() & named
    fallback = F.get(F.filter(links, product), F.lit(0))
    done = read.filter(~asked).select(page, F.coalesce("_early", fallback).alias("_link"))
    opened = read.filter(asked).select(page, html, "_links")
    found = expand_text(opened, html, [page, "_links"], T.StructType([T.StructField("_found", T.ArrayType(T.StringType()))]),
                        html_nodes.first_anchors(classes))
    late = [checked(F.get("_found", F.lit(classes.index(within))) if within else first(part)) for within, part in rest]
    parsed = found.select(page, F.coalesce(*late, fallback).alias("_link"))
    link = F.col("_link")
    return done.unionByName(parsed).select(page, F.when(link.isNotNull(), absolute_url(link, origin)).alias("link"))


def _anchors(html: Column | str) -> Column:
    """Array of (pos, href, inner) over the links of a page."""
    attrs = F.regexp_extract_all(_uncommented(html), F.lit(_ANCHOR), F.lit(1))
    inner = F.regexp_extract_all(_uncommented(html), F.lit(_ANCHOR), F.lit(2))
    pairs = F.transform(F.arrays_zip(attrs.alias("a"), inner.alias("i")), lambda x, pos: F.struct(
        pos.cast("bigint").alias("pos"), _href_of(x["a"]).alias("href"), x["i"].alias("inner")))
    return F.filter(pairs, lambda x: slug_from_url(x["href"]) != "")


def _linking(links: str, test: str) -> Column:
    return F.filter(links, lambda x: x["href"].rlike(test))


_LINK_OUT = T.StructType([T.StructField("pos", T.LongType()), T.StructField("href", T.StringType()),
                          T.StructField("card_name", T.StringType())])


def extract_catalog(pages: DataFrame, origin: str, link_tests: Sequence[str] = tuple(V.CARD_LINK_TESTS),
                    list_class: str = V.CARD_LIST_CLASS, page: str = "page", html: str = "html") -> DataFrame:
    """Card links: card_id, card_name, hinban, url of the first page and place an id is seen.

    Per page the first test that finds anything supplies the links. Only pages that fail
    all tests are parsed in Python for links inside an element of ``list_class``.
    """
    links = pages.select(F.col(page).alias("page"), F.col(html).alias("html"), _anchors(html).alias("_all"))
    chosen = F.array().cast(links.schema["_all"].dataType)
    for test in reversed(list(link_tests)):
        hits = _linking("_all", test)
        chosen = F.when(F.size(hits) > 0, hits).otherwise(chosen)
    tested = links.withColumn("_links", chosen)
    by_test = (tested.select("page", F.explode("_links").alias("x"))
               .select("page", "x.pos", "x.href", page_text("x.inner").alias("card_name")))
    rest = tested.filter(F.size("_links") == 0).filter(F.contains("html", F.lit(list_class)))
    by_class = expand_text(rest.select("page", "html"), "html", ["page"], _LINK_OUT,
                           html_nodes.anchors_inside(list_class))
    found = by_test.unionByName(by_class).withColumn("card_id", slug_from_url("href"))
    first = first_per_key(found.filter(F.col("card_id") != ""), ["card_id"], ["page", "pos"])
    return first.select("card_id", "card_name", extract_code("card_name").alias("hinban"),
                        absolute_url("href", origin).alias("url"), "page", "pos")


def extract_numbers(pages: DataFrame, classes: Mapping[str, Sequence[tuple[str, str]]] = V.PRODUCT_NUMBER_CLASSES,
                    patterns: Mapping[str, Sequence[str]] = V.PRODUCT_NUMBER_PATTERNS,
                    page: str = "page", html: str = "html") -> DataFrame:
    """Numbers of product pages, one column per label, "" where nothing was found.

    Per label the marked elements are tried in order (the first element of each, if its
    text has digits), then the patterns over the page text.
    """
    tests = [test for label in classes for test in classes[label]]
    # a page without any of the marks needs no parsing
    marked = F.when(F.col(html).rlike("|".join(re.escape(token) for _, token in tests)), F.col(html))
    out = T.StructType([T.StructField("_found", T.ArrayType(T.StringType()))])
    texts = expand_text(pages.select(F.col(page), page_text(html).alias("_text"), marked.alias("_html")),
                        "_html", [page, "_text"], out, html_nodes.first_texts(tests))
    columns, offset = [], 0
    for label in classes:
        candidates = [digits_only(F.get("_found", F.lit(offset + k))) for k in range(len(classes[label]))]
        offset += len(classes[label])
        candidates.append(first_match("_text", patterns.get(label, ())))
        columns.append(F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit("")).alias(label))
    return texts.select(page, *columns)
