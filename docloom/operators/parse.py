"""Text extraction: raw files in, parsed documents out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from docloom.functions import charset as C
from docloom.functions import text as T
from docloom.functions.paths import date_text, file_extension, file_name, has_extension

# Extensions read as HTML and as plain text. What has a name without any
# extension is told by its content.
HTML_EXTENSIONS = ["html", "htm", "xhtml"]
TEXT_EXTENSIONS = ["", "txt", "text", "md", "log", "csv", "json", "xml"]

# The page metadata added to a page's text, in this order.
META_NAMES = ["author", "subject", "keywords", "description"]

# A handler gets (path, body) of one file and gives its text, or None if it has none.
Handler = Callable[[str, bytes], str | None]
# A factory makes the handlers by lower-case extension, once per partition, inside the task.
HandlerFactory = Callable[[], dict[str, Handler]]


def with_file_facts(df: DataFrame, path: str = "path") -> DataFrame:
    return df.withColumns({"fileName": file_name(F.col(path)), "extension": file_extension(F.col(path))})


def route(path: Column) -> Column:
    """Which reader a file goes to by its name: ``html``, ``text`` or ``other``."""
    return (
        F.when(has_extension(path, *HTML_EXTENSIONS), "html")
        .when(has_extension(path, *TEXT_EXTENSIONS), "text")
        .otherwise("other")
    )


def _with_facts(df: DataFrame, html: Column) -> DataFrame:
    """Add the metadata columns. Steps of their own, so that no search is done twice."""
    raw = {name: T.raw_meta(F.col("_tags"), name) for name in META_NAMES}
    found = df.withColumn("_shown", T.without_hidden(html)).withColumn("_tags", T.meta_tags(F.col("_shown")))
    found = found.withColumns({"title": T.raw_title(F.col("_shown")), **raw})
    return found.withColumns({name: T.present(F.col(name)) for name in ["title", *META_NAMES]}).drop("_shown", "_tags")


def html_metadata(df: DataFrame, html: str = "html") -> DataFrame:
    """Add the page's title and ``<meta>`` facts as columns, null when absent."""
    return _with_facts(df, F.col(html))


def with_dates(text: Column, *dates: Column) -> Column:
    """Append dates as ``yyyy-MM-dd`` lines, leaving out those that are missing."""
    return F.concat_ws("\n", text, *[F.nullif(date_text(d), F.lit("")) for d in dates])


def extract_text(df: DataFrame, handlers: HandlerFactory | None = None) -> DataFrame:
    """``(path, body binary)`` to ``(path, body string, fileName, extension, status)``.

    Text is read in the charset that its bytes tell, and a file whose name has no extension goes to the reader
    for its content (``functions.charset``). The files are read once. Pages and plain text are done in the JVM; only the bodies of
    other formats enter Python, for the handler of their extension. ``status`` is ``ok``,
    ``unsupported`` (no handler), ``error`` (the handler failed) or ``empty`` (no body, or a
    handler that found no text);
    the text of a file that is not ``ok`` is ``''``, so no file is lost.
    """
    routed = with_file_facts(df.select("path", F.col("body").alias("_bytes"))).withColumn("_route", route(F.col("path")))
    is_html, is_other = F.col("_route") == "html", F.col("_route") == "other"
    read = routed.withColumn("_charset", F.when(~is_other, C.charset(F.col("_bytes"))))
    read = read.withColumn("body", F.when(~is_other, C.decoded(F.col("_bytes"), F.col("_charset"))))
    unnamed = (F.col("extension") == "") & F.col("_bytes").isNotNull()
    read = read.withColumn("_kind", F.when(unnamed, C.content_type(F.col("_bytes"), F.col("body"))).otherwise(F.col("extension")))
    told = F.when(F.col("_kind") == "html", "html").when(F.col("_kind").isin("txt", "xml"), "text").otherwise("other")
    read = read.withColumn("_route", F.when(unnamed, told).otherwise(F.col("_route")))
    if handlers is None:
        outcome = F.struct(F.lit("").alias("text"), F.lit("unsupported").alias("status"))
    else:
        outcome = _handled(handlers)("path", "_kind", F.when(is_other, F.col("_bytes")), is_other)
    read = read.withColumn("_other", outcome)
    read = read.withColumn("_visible", F.when(is_html, T.without_tags(F.col("body"))))
    facts = _with_facts(read, F.when(is_html, F.col("body")))
    page = F.concat_ws("\n", T.squeeze(T.decode_entities(F.col("_visible"))), "title", *META_NAMES)
    text = F.when(is_other, F.col("_other")["text"]).when(is_html, page).otherwise(F.col("body"))
    status = (
        F.when(is_other, F.col("_other")["status"]).when(F.col("_bytes").isNull(), "empty").otherwise("ok")
    )
    return facts.select(
        "path", F.coalesce(text, F.lit("")).alias("body"), "fileName", "extension", status.alias("status")
    )


def _handled(factory: HandlerFactory):
    """The handlers as a vectorised column. Marked so that it is evaluated once per row."""

    @F.pandas_udf("text string, status string")
    def run(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        handlers = factory()
        for paths, extensions, bodies, chosen in batches:
            rows = [
                _one(handlers.get(extension.lower()), path, body) if wanted else ("", "ok")
                for path, extension, body, wanted in zip(paths, extensions, bodies, chosen)
            ]
            yield pd.DataFrame(rows, columns=["text", "status"])

    return run.asNondeterministic()


def _one(handler: Handler | None, path: str, body: bytes | None) -> tuple[str, str]:
    if handler is None:
        return "", "unsupported"
    if body is None:
        return "", "empty"
    try:
        text = handler(path, bytes(body))
        return ("", "empty") if text is None else (text, "ok")
    except Exception:  # one bad file must not end the job
        return "", "error"


def parse_documents(df: DataFrame, language: Callable[[Column], Column], handlers: HandlerFactory | None = None) -> DataFrame:
    """Raw files to ``(path, body, fileName, extension, lang)``.

    ``language`` turns the text column into a language column, for example
    ``LanguageModel.column``. It is evaluated beside the text, so texts are not shuffled.
    """
    text = extract_text(df, handlers)
    return text.select("path", "body", "fileName", "extension", language(F.col("body")).alias("lang"))


def encrypted_pdf(path: Column, body: Column) -> Column:
    """A PDF whose bytes announce encryption. Approximate: only the marker is looked for."""
    return (
        has_extension(path, "pdf")
        & F.startswith(body, F.lit(b"%PDF"))
        & F.contains(body, F.lit(b"/Encrypt"))
    )


def rescue(df: DataFrame, handler_factory: Callable[[], Handler], predicate: Column | None = None) -> DataFrame:
    """Run a fallback reader over the files that ``predicate`` picks; keep what it could read.

    The test runs in the JVM before any body enters Python.
    """
    chosen = predicate if predicate is not None else encrypted_pdf(F.col("path"), F.col("body"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        handler = handler_factory()
        for frame in frames:
            texts = [_rescued(handler, path, body) for path, body in frame.itertuples(index=False)]
            yield pd.DataFrame({"path": frame["path"], "body": texts})

    rescued = df.filter(chosen).select("path", "body").mapInPandas(run, "path string, body string")
    return keep_read(rescued)


def _rescued(handler: Handler, path: str, body: bytes) -> str | None:
    try:
        return handler(path, bytes(body))
    except Exception:  # one bad file must not end the job
        return None


def keep_read(df: DataFrame) -> DataFrame:
    return df.filter(F.col("body").isNotNull())


def parse_stats(df: DataFrame) -> DataFrame:
    """Exact number of files per status, unlike counters, which a retried task adds to twice."""
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def observed(df: DataFrame, name: str = "parse") -> tuple[DataFrame, Observation]:
    """``df`` with progress counters that are filled in when it is next written."""
    watch = Observation(name)
    status = F.col("status")
    return (
        df.observe(
            watch,
            F.count(F.lit(1)).alias("parsed"),
            F.count_if(status.isin("error", "corrupt")).alias("error"),
            F.count_if(status == "unsupported").alias("unsupported"),
        ),
        watch,
    )
