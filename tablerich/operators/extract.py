"""Page to text: markdown, titles, focused excerpts, and errors for URLs that gave nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablerich.operators.markup import to_markdown
from tablerich.operators.naming import keep_if, strip
from tablerich.operators.search import check_objective, query_terms

# Limits of a request.
MAX_URLS = 20
def title_of(html: Column) -> Column:
    # The title is text only; it is read like the text of a page.
    found = strip(to_markdown(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))
    return keep_if(found, lambda t: t != "")


def publish_date_of(html: Column) -> Column:
    found = F.regexp_extract(html, r'(?i)(?:datetime|published_time" content)="(\d{4}-\d{2}-\d{2})', 1)
    return F.when(found != "", found)


def truncate(c: Column, n: int, mark: str = "...") -> Column:
    """The first ``n`` characters, marked when something was cut."""
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit(mark))).otherwise(c)


def sentences(text: Column) -> Column:
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1\n")
    return F.array_remove(F.transform(F.split(marked, r"\n+"), strip), "")


def focused_excerpts(text: Column, keywords: Sequence[str], k: int = 3) -> Column:
    """The ``k`` sentences with most keyword hits, in text order; computed inside the row."""
    words = [w.lower() for w in keywords]

    def hits(low: Column) -> Column:
        found = F.lit(0)
        for w in words:
            found = found + F.floor((F.length(low) - F.length(F.replace(low, F.lit(w), F.lit("")))) / len(w))
        return found

    lowered = F.transform(sentences(text), lambda s, i: F.struct(F.lower(s).alias("low"), i.alias("pos"), s.alias("text")))
    scored = F.transform(
        lowered, lambda x: F.struct((-hits(x["low"])).alias("worse"), x["pos"].alias("pos"), x["text"].alias("text"))
    )
    best = F.slice(F.array_sort(F.filter(scored, lambda x: x["worse"] < 0)), 1, k)
    in_order = F.array_sort(F.transform(best, lambda x: F.struct(x["pos"].alias("pos"), x["text"].alias("text"))))
    return F.transform(in_order, lambda x: x["text"])


def extract(
    requests: DataFrame, pages: DataFrame, *, objective: str | None = None, keywords: Sequence[str] = (),
    excerpts: bool = True,
    full_content: bool | int = False, url: str = "url", html: str = "html", version: str | None = None,
    most_urls: int | None = None, unique: bool = False, main: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Results ``(url, title, publish_date, excerpts[, full_content])`` and errors of the requested URLs.

    A URL that is not in ``pages`` is ``not_found`` (404); a page without text is ``empty_content``.
    ``version`` names a column of ``pages`` that tells the newest page of a URL; ``most_urls`` (20 for an interactive
    request) limits the URLs that are asked for. ``unique`` promises one page for each URL: then no page is moved to find
    the newest. ``main`` keeps the main text only. Keywords, or the words of the objective, choose the excerpts; with neither they are the whole text.
    """
    keywords = keywords or (query_terms(check_objective(objective)) if objective else ())
    # Blank words would be found everywhere.
    keywords = [w for w in keywords if w.strip()]
    wanted = requests.select(F.col(url)).distinct()
    if most_urls is not None and wanted.limit(most_urls + 1).count() > most_urls:
        raise ValueError(f"at most {most_urls} URLs in one request")
    # One page for each URL: the newest by ``version``, of equal ones the longest text of the page.
    newest = F.struct(F.lit(0) if version is None else F.col(version), F.length(html), F.col(html).alias("html"))
    # A semi join lets Spark send a small request list to the pages instead of moving the pages.
    known = pages.select(F.col(url).alias("_u"), F.col(html).alias("_h"), newest.alias("_v")).join(wanted, F.col("_u") == F.col(url), "left_semi")
    if unique:
        known = known.select("_u", "_h")
    else:
        known = known.groupBy("_u").agg(F.max("_v").alias("_v")).select("_u", F.col("_v.html").alias("_h"))
    found = known.withColumnRenamed("_u", url).withColumn("_text", F.coalesce(to_markdown(F.col("_h"), main), F.lit("")))
    columns = [F.col(url), title_of(F.col("_h")).alias("title"), publish_date_of(F.col("_h")).alias("publish_date")]
    if excerpts:
        columns.append(
            (focused_excerpts(F.col("_text"), keywords) if keywords else F.array("_text")).alias("excerpts")
        )
    if full_content is not False:
        text = F.col("_text") if full_content is True else F.left("_text", F.lit(int(full_content)))
        columns.append(text.alias("full_content"))
    missing = wanted.join(pages.select(F.col(url).alias("_u")), F.col(url) == F.col("_u"), "left_anti")
    failed = missing.select(url, F.lit("not_found").alias("error_type"), F.lit(404).alias("http_status_code")).unionByName(
        found.filter(F.col("_text") == "").select(
            url, F.lit("empty_content").alias("error_type"), F.lit(200).alias("http_status_code")
        )
    )
    errors = failed.withColumn("content", F.lit(None).cast("string"))
    results = found.filter(F.col("_text") != "")
    return results.select(*columns), errors
