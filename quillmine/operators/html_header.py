"""Header tables of HTML pages: the rows of the table named `info`, and labelled fields in them.

Only parsing HTML needs Python; it gives rows as arrays, and the rules for fields are expressions over them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.functions import text as T

ROW_TYPE = "array<struct<text:string,cells:array<string>,bold_values:array<string>>>"
#: Labels as they stand in the pages.
CATEGORY, PROCEEDING, REGISTER = "Категорія справи", "Номер судового провадження", "Номер кримінального провадження в ЄРДР"
DATES = ("Надіслано судом", "Зареєстровано", "Забезпечено надання загального доступу")
CATEGORY_PATTERN = r"(?U)Категорія\s+справи(?:\s*№)?\s*(.*)$"
REVIEW_ROOT = "https://reyestr.court.gov.ua/Review/"


class _Tables(HTMLParser):
    """Closed tables in the order of their ends. Rows, cells and bold text are one flat state, so a row inside a row starts
    it anew, and text outside rows is lost."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.closed: list[tuple[str | None, list[dict]]] = []
        self.open: list[tuple[str | None, list[dict]]] = []
        self.text: dict[str, list[str] | None] = dict.fromkeys(("row", "cell", "bold"))
        self.cells: list[str] = []
        self.bolds: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append((dict(attrs).get("id"), []))
        elif not self.open:
            return
        elif tag == "tr":
            self.text["row"], self.cells, self.bolds = [], [], []
        elif self.text["row"] is not None and tag in ("td", "th", "b"):
            self.text["bold" if tag == "b" else "cell"] = []

    def _take(self, part: str) -> str:
        value, self.text[part] = _plain("".join(self.text[part] or [])), None
        return value

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag == "table":
            self.closed.append(self.open.pop())
        elif tag == "b" and self.text["bold"] is not None:
            self.bolds += filter(None, [self._take("bold")])
        elif tag in ("td", "th") and self.text["cell"] is not None:
            self.cells += filter(None, [self._take("cell")])
        elif tag == "tr" and self.text["row"] is not None:
            self.open[-1][1].append({"text": self._take("row"), "cells": self.cells, "bold_values": self.bolds})
            self.cells, self.bolds = [], []

    def handle_data(self, data):
        if self.open and self.text["row"] is not None:
            for part in self.text.values():
                if part is not None:
                    part.append(data)


def _plain(value: str) -> str:
    import html

    return " ".join(html.unescape(value).replace("\xa0", " ").split())


def rows_of_table(page: str | None, table_id: str = "info") -> list[dict] | None:
    """H1: rows of the first closed table with the id; null if there is none."""
    if page is None:
        return None
    parser = _Tables()
    parser.feed(page)
    parser.close()
    return next((rows for name, rows in parser.closed if name == table_id), None)


def table_rows(page: Column, table_id: str = "info") -> Column:
    @F.pandas_udf(ROW_TYPE)
    def parse(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: rows_of_table(p, table_id))

    return parse(page)


def _first(values: Column) -> Column:
    return F.get(values, F.lit(0))


def value_in_row(row: Column, label: str, stops: tuple[str, ...] = ()) -> Column:
    """For each cell that names the label, in order: the labelled value, what follows the label, the next cell; else the
    labelled value in the row's text."""
    cells = row["cells"]

    def of_cell(cell, i):
        rest = T.strip(F.regexp_replace(cell, "(?U)^" + re.escape(label) + r"\s*:?\s*", ""))
        after = F.get(F.slice(cells, i + 2, F.lit(1)), F.lit(0))
        return F.when(F.contains(cell, F.lit(label)), F.coalesce(T.labelled_value(cell, label, stops), F.when((rest != "") & (rest != cell), rest), after))

    found = F.filter(F.transform(cells, of_cell), lambda x: x.isNotNull())
    return F.coalesce(_first(found), T.labelled_value(row["text"], label, stops))


def category_in_row(row: Column) -> Column:
    """T21."""
    in_text = lambda c: F.nullif(T.without_case_number(F.regexp_extract(c, CATEGORY_PATTERN, 1)), F.lit(""))
    cells = row["cells"]

    def of_cell(cell, i):
        later = F.filter(F.transform(F.slice(cells, i + 2, F.greatest(F.size(cells), F.lit(1))), T.without_case_number), lambda x: x != "")
        return F.when(F.contains(cell, F.lit(CATEGORY)), F.coalesce(in_text(cell), _first(later)))

    found = F.filter(F.transform(cells, of_cell), lambda x: x.isNotNull())
    return F.coalesce(_first(found), in_text(row["text"]))


def header_fields(pages: DataFrame, page_column: str = "html") -> DataFrame:
    """Pages with the six values of the header table. A row is read by the first label it holds; later rows replace
    what earlier ones gave (also by nothing)."""
    rows = pages.withColumn("_rows", table_rows(F.col(page_column)))
    has = lambda row, label: F.contains(row["text"], F.lit(label))
    any_date = lambda row: has(row, DATES[0]) | has(row, DATES[1]) | has(row, DATES[2])
    all_dates = lambda row: has(row, DATES[0]) & has(row, DATES[1]) & has(row, DATES[2])
    is_category = lambda row: has(row, CATEGORY)
    is_dates = lambda row: ~is_category(row) & any_date(row)
    is_proceeding = lambda row: ~is_category(row) & ~any_date(row) & has(row, PROCEEDING)
    is_register = lambda row: ~is_category(row) & ~any_date(row) & ~has(row, PROCEEDING) & has(row, REGISTER)
    last = lambda test: F.try_element_at(F.filter("_rows", test), F.lit(-1))
    bold = lambda row, k: F.get(row["bold_values"], F.lit(k))

    def date(k):
        row = last(is_dates)
        three = all_dates(row) & (F.size(row["bold_values"]) >= 3)
        return T.clean_date(F.when(three, bold(row, k)).otherwise(value_in_row(row, DATES[k], DATES[k + 1 :])))

    def numbered(test, label):
        row = last(test)
        return T.clean_value(F.coalesce(bold(row, 0), value_in_row(row, label)))

    category = last(is_category)
    with_bold = F.nullif(T.without_case_number(bold(category, 0)), F.lit(""))
    return rows.select(
        *pages.columns,
        F.array_join(F.transform("_rows", lambda r: r["text"]), "\n").alias("info_table_text"), F.to_json("_rows").alias("info_table_rows_json"),
        F.when(F.size(category["bold_values"]) > 0, with_bold).otherwise(category_in_row(category)).alias("case_category"),
        date(0).alias("sent_by_court"), date(1).alias("registered"), date(2).alias("public_access_provided"),
        numbered(is_proceeding, PROCEEDING).alias("court_proceeding_number"), numbered(is_register, REGISTER).alias("criminal_proceeding_number"),
    )


def review_url(url: Column, doc_id: Column) -> Column:
    """the URL if its path goes through /Review/, else one made from the id, else null."""
    own = T.header_text(url)
    is_review = F.regexp_extract(own, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1).contains("/Review/")
    number = F.nullif(T.header_text(doc_id.cast("string")), F.lit(""))
    return F.when(is_review, own).otherwise(F.concat(F.lit(REVIEW_ROOT), F.replace(F.url_encode(number), F.lit("+"), F.lit("%20"))))


def review_error(url: Column, doc_id: Column) -> Column:
    """why there is no review URL; null if there is."""
    found = review_url(url, doc_id).isNotNull()
    return F.when(found, F.lit(None).cast("string")).when(T.header_text(url) != "", F.lit("not a header page")).otherwise(F.lit("no identifier"))


def fetched(rows: DataFrame, url_column: str, fetch: Callable[[str], tuple[int, str]], pause: float = 0.0) -> DataFrame:
    """Rows with html, status and fetch_error by an injected fetcher; a failure is kept with its row. Each
    partition fetches on its own; store the result before using it twice."""
    schema = rows.schema.simpleString()[len("struct<") : -1] + ",html:string,status:int,fetch_error:string"

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for batch in batches:
            got = []
            for url in batch[url_column]:
                try:
                    status, page = fetch(url)
                    got.append((page, status, None))
                except Exception as error:  # any failure belongs to its row
                    got.append((None, None, f"{type(error).__name__}: {error}"))
                if pause:
                    time.sleep(pause)
            yield batch.assign(**{name: [g[k] for g in got] for k, name in enumerate(("html", "status", "fetch_error"))})

    return rows.mapInPandas(go, f"struct<{schema}>")


#: What a header page must give some of.
VALUES = ("case_category", "sent_by_court", "registered", "public_access_provided", "court_proceeding_number", "criminal_proceeding_number")


def with_parse_error(parsed: DataFrame, status_column: str = "status", error_column: str = "fetch_error") -> DataFrame:
    """H3: parsed headers with error: the fetch's own, else one where the page gave none of the values."""
    empty = F.lit(True)
    for c in VALUES:
        empty = empty & (F.coalesce(T.strip(F.col(c)), F.lit("")) == "")
    return parsed.withColumn("error", F.coalesce(F.col(error_column), F.when(empty, F.lit("the page has no header values"))))


def decoded(body: Column, charset: Column) -> Column:
    """A page's bytes by the charset of its response, else UTF-8; what cannot be read is replaced."""

    @F.pandas_udf("string")
    def read(bodies: pd.Series, charsets: pd.Series) -> pd.Series:
        import codecs

        def one(data, name):
            if data is None:
                return None
            try:
                codecs.lookup(name or "utf-8")
            except LookupError:
                name = "utf-8"
            return bytes(data).decode(name or "utf-8", "replace")

        return pd.Series([one(b, c) for b, c in zip(bodies, charsets)], dtype="object")

    return read(body, charset)


def in_batches(rows: DataFrame, order: str, size: int, run: Callable[[DataFrame], DataFrame], each: Callable[[int, DataFrame], None] | None = None) -> int:
    """H4: run over consecutive batches of rows by the order column; each gets a batch's number and its stored result. How many
    batches there were."""
    from quillmine.operators.tracking import batch_number, positions
    from quillmine.sources.shared import stored

    numbered = positions(rows, order, name="_place").withColumn("_batch", batch_number(F.col("_place"), size)).drop("_place")
    n = (numbered.agg(F.max("_batch")).first()[0] if rows.columns else None)
    n = 0 if n is None else n + 1
    for k in range(n):
        result = stored(run(numbered.where(F.col("_batch") == k).drop("_batch")), "header-batch")
        if each:
            each(k, result)
    return n
