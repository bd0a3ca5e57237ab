"""The registered queries, one per operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import geo
from docloom.functions import paths as P
from docloom.functions.text import html_text
from docloom.operators import clustering, facets, index, language, parse, search, spelling, words
from docloom.plans import fixtures as X
from docloom.session import scratch_path
from docloom.functions.sql import register_sql_functions
from docloom.sinks.tables import pack_files, save_table
from docloom.sources.archives import read_archives
from docloom.sources.files import drop_blacklisted, expand_archives, scan_files
from docloom.sources.tables import read_table, register_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Words that the search queries look for, and a misspelt one.
TERMS = "le of der"
PHRASE = '"of the" "de la"'
NEAR = '"the of"~3 "the of the"~3'
MISSPELT = ["thes", "oderr", "ndd", "quee", "the", "xyzzyx"]

CENTER = (48.85, 2.35)


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


# --- sources and sinks -------------------------------------------------------------


@query
def scan_files_(spark, sf_dir):
    """Documents written as files, one folder per source, and scanned back."""
    folder = scratch_path(spark, "files")
    X.docs(spark, sf_dir).select("source", "body").write.partitionBy("source").option("maxRecordsPerFile", 500).text(folder)
    found = scan_files(spark, folder)
    source = F.regexp_extract("path", "source=([^/]+)/", 1)
    text = F.regexp_replace(F.col("body").cast("string"), "\n$", "")
    lines = found.select(source.alias("source"), "lang", F.explode(F.split(text, "\n")).alias("line"))
    return lines.groupBy("source", "lang").agg(
        F.sum(F.octet_length("line") + 1).alias("bytes"),
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("line").alias("distinct_lines"),
    )


@query
def blacklist_filter(spark, sf_dir):
    name = (
        F.when(F.col("lang") == "es", "/THUMBS.DB")
        .when(F.col("lang") == "de", "/.ds_store")
        .when(F.col("lang") == "fr", "/Thumbs.db.txt")
        .otherwise("")
    )
    named = X.docs(spark, sf_dir).select(F.concat("path", name).alias("path"), "n_chars")
    return drop_blacklisted(named)


@query
def expand_archives_(spark, sf_dir):
    raw = X.zipped(spark, sf_dir).unionByName(X.raw_files(spark, sf_dir, X.pages))
    return expand_archives(raw).select(
        "path", "lang", "status", F.length("body").alias("bytes"), F.sha2("body", 256).alias("sha")
    )


@query
def large_archives(spark, sf_dir):
    """Archives of many documents each, read by ranges of a megabyte."""
    found = read_archives(X.archived(spark, sf_dir), range_bytes=1024 * 1024)
    return found.select(F.regexp_extract("path", r"\.zip(/.*)", 1).alias("path"), "status", F.length("body").alias("bytes"), F.sha2("body", 256).alias("sha"))


@query
def pack_files_(spark, sf_dir):
    path = scratch_path(spark, "packed")
    pack_files(X.raw_files(spark, sf_dir, X.docs, X.pages), path, size="8388608")
    return read_table(spark, path).select("path", "lang", F.length("body").alias("bytes"), F.sha2("body", 256).alias("sha"))


@query
def refuse_existing(spark, sf_dir):
    """All documents written; a second writer is refused and the first result stays."""
    path = scratch_path(spark, "kept")
    save_table(X.docs(spark, sf_dir).select("path", "lang"), path)
    try:
        save_table(X.docs(spark, sf_dir).limit(1).select("path", "lang"), path)
        refused = False
    except AnalysisException:
        refused = True
    return read_table(spark, path).select("path", "lang", F.lit(refused).alias("refused"))


@query
def sql_functions(spark, sf_dir):
    """The functions by their names in SQL text."""
    register_sql_functions(spark)
    return X.docs(spark, sf_dir).selectExpr(
        "path",
        "extract_file_name(path) AS name",
        "extract_extension(path) AS extension",
        "document_id(path) AS id",
        "path_to_words(path) AS words",
        "size(text_words(body)) AS n_words",
    )


@query
def catalog_join(spark, sf_dir):
    root = scratch_path(spark, "run")
    save_table(X.parsed(spark, sf_dir), f"{root}/documents")
    save_table(X.lang_table(spark, sf_dir), f"{root}/lang")
    save_table(X.cluster_table(spark, sf_dir), f"{root}/clusters")
    save_table(words.wordcount(words.tokenize(read_table(spark, f"{root}/documents"))), f"{root}/wordcount")
    prefix = f"run_{root[-8:]}_"
    register_tables(spark, root, prefix=prefix)
    return spark.sql(
        f"""
        SELECT c.cluster, l.lang, count(*) AS documents, sum(w.distinct_words) AS distinct_words, sum(w.words) AS words
        FROM {prefix}documents d
        JOIN {prefix}lang l ON l.path = d.path
        JOIN {prefix}clusters c ON c.path = d.path
        JOIN (SELECT f, count(*) AS distinct_words, sum(c) AS words FROM {prefix}wordcount GROUP BY f) w ON w.f = d.path
        GROUP BY c.cluster, l.lang
        """
    )


@query
def index_upsert(spark, sf_dir):
    """All documents indexed, then those with a label written again with another language."""
    path = scratch_path(spark, "upsert")
    index.write_index(index.latest(index.index_documents(X.parsed(spark, sf_dir))), path, shard_chars=1)
    again = index.index_documents(X.parsed(spark, sf_dir), lang=X.lang_table(spark, sf_dir))
    index.upsert_index(again, path, shard_chars=1)
    return spark.read.parquet(path).select("id", "path", "lang", "cluster", F.length("text").alias("chars"))


# --- projections, filters ----------------------------------------------------------


@query
def parse_documents(spark, sf_dir):
    model = X.language_model(spark, sf_dir)
    raw = X.raw_files(spark, sf_dir, X.docs, X.pages, X.turns)
    parsed = parse.parse_documents(raw, lambda body: model.column(body, language.GATE))
    return parsed.select(
        "path", "fileName", "extension", "lang", F.length("body").alias("chars"), F.sha2("body", 256).alias("sha")
    )


@query
def index_defaults(spark, sf_dir):
    return index.with_defaults(X.parsed(spark, sf_dir)).select(
        "path", "fileName", "extension", "lang", "cluster", F.length("body").alias("chars")
    )


@query
def index_documents(spark, sf_dir):
    return index.index_documents(
        X.parsed(spark, sf_dir), X.lang_table(spark, sf_dir), X.cluster_table(spark, sf_dir)
    )


@query
def join_lang(spark, sf_dir):
    docs = index.with_defaults(X.parsed(spark, sf_dir))
    return index.enrich(docs, lang=X.lang_table(spark, sf_dir)).drop("body")


@query
def join_cluster(spark, sf_dir):
    docs = index.with_defaults(X.parsed(spark, sf_dir))
    return index.enrich(docs, clusters=X.cluster_table(spark, sf_dir), how="left").drop("body")


@query
def rescue_filter(spark, sf_dir):
    """Documents as PDFs, the French ones marked as encrypted. The reader gives up on one-liners."""
    marker = F.when(F.col("lang") == "fr", "%PDF-1.4 /Encrypt ").otherwise("%PDF-1.4 ")
    raw = X.docs(spark, sf_dir).select(
        F.concat("path", F.lit(".Pdf")).alias("path"), F.encode(F.concat(marker, "body"), "UTF-8").alias("body")
    )

    def reader():
        return lambda path, body: body.decode()[len("%PDF-1.4 /Encrypt ") :] if b"\n" in body else None

    return parse.rescue(raw, reader).select("path", F.length("body").alias("chars"), F.sha2("body", 256).alias("sha"))


@query
def extension_route(spark, sf_dir):
    raw = X.raw_files(spark, sf_dir, X.docs, X.pages, X.turns)
    extension = P.file_extension(F.col("path"))
    return raw.groupBy(parse.route(F.col("path")).alias("route"), extension.alias("extension")).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(P.has_extension(F.col("path"), "TXT", "docx")).alias("txt_or_docx"),
    )


@query
def lang_routing(spark, sf_dir):
    """Language codes in upper case for the longer texts: routing ignores the case."""
    code = F.when(F.col("n_chars") > 1000, F.upper("lang")).otherwise(F.col("lang"))
    docs = X.docs(spark, sf_dir).select("path", "body", code.alias("lang"))
    return docs.select(
        "path",
        "lang",
        F.sha2(index.routed_text(F.col("lang"), F.col("body"), "fr"), 256).alias("sha_fr"),
        F.sha2(index.routed_text(F.col("lang"), F.col("body"), "en"), 256).alias("sha_en"),
    )


@query
def filter_query(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    kept = facets.filter_query(orders, "o_orderstatus", "F")
    return facets.filter_query(kept, "o_orderpriority", "1-URGENT", "5-LOW", exclude=True)


@query
def range_filter(spark, sf_dir):
    items = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return items.filter(
        facets.in_range(F.col("l_quantity"), 10.0, 20.0, include_high=False)
        & facets.in_range(F.col("l_discount"), 0.02, None, include_low=False)
    )


@query
def geo_radius(spark, sf_dir):
    lat, lng = (F.col("c_custkey") % 181 - 90).cast("double"), (F.col("c_custkey") % 361 - 180).cast("double")
    points = X.table(spark, sf_dir, "customer").select("c_custkey", lat.alias("lat"), lng.alias("lng"))
    near = points.filter(geo.within(F.col("lat"), F.col("lng"), *CENTER, radius=3000))
    return near.select(
        "c_custkey",
        F.round(geo.distance(F.col("lat"), F.col("lng"), *CENTER), 3).alias("km"),
        F.round(geo.distance(F.col("lat"), F.col("lng"), *CENTER, unit="miles", calc="plane"), 3).alias("flat_miles"),
    )


# --- words -------------------------------------------------------------------------


@query
def tokenize(spark, sf_dir):
    tokens = words.tokenize(X.texts(spark, sf_dir))
    return tokens.select("path", F.size("words").alias("n"), F.array_join("words", " ").alias("words"))


@query
def shingles(spark, sf_dir):
    tokens = words.tokenize(X.texts(spark, sf_dir), ngrams=(2, 3))
    return tokens.select("path", F.size("words").alias("n"), F.sha2(F.array_join("words", "|"), 256).alias("sha"))


@query
def wordcount(spark, sf_dir):
    return words.wordcount(words.tokenize(X.texts(spark, sf_dir)))


@query
def doc_freq(spark, sf_dir):
    return words.doc_freq(words.tokenize(X.texts(spark, sf_dir)))


@query
def tfidf(spark, sf_dir):
    weighted = words.tfidf(words.tokenize(X.texts(spark, sf_dir)))
    return weighted.withColumn("tfidf", F.round("tfidf", 6))


# --- parsing -----------------------------------------------------------------------


@query
def extract_html(spark, sf_dir):
    raw = X.raw_files(spark, sf_dir, X.pages)
    return parse.extract_text(raw).select("path", "fileName", "extension", "status", "body")


@query
def extract_text(spark, sf_dir):
    raw = X.raw_files(spark, sf_dir, X.docs, X.pages, X.turns)
    return parse.extract_text(raw).select(
        "path", "extension", "status", F.length("body").alias("chars"), F.sha2("body", 256).alias("sha")
    )


@query
def charset_documents(spark, sf_dir):
    """Every document in three encodings, under a name without extension and without a declaration."""
    text = F.col("body")
    written = {
        "utf-8": F.encode(text, "UTF-8"),
        "utf-16le": F.encode(text, "UTF-16LE"),
        "utf-16be": F.concat(F.lit(b"\xfe\xff"), F.encode(text, "UTF-16BE")),
    }
    return _read_back(X.docs(spark, sf_dir).select("path", "body"), written)


@query
def charset_pages(spark, sf_dir):
    """Every page in four charsets, under a name without extension."""
    declared = F.regexp_replace(F.col("body"), r"(?i)<meta charset=[^>]*>", '<meta charset="iso-8859-1">')
    written = {
        "utf-8": F.encode(F.col("body"), "UTF-8"),
        "iso-8859-1": _narrow(declared, F.col("body")),
        "utf-16le": F.concat(F.lit(b"\xff\xfe"), F.encode(F.col("body"), "UTF-16LE")),
        "utf-16be": F.encode(F.col("body"), "UTF-16BE"),
    }
    return _read_back(X.pages(spark, sf_dir), written)


def _narrow(text, given):
    """``text`` in a byte a character, or ``given`` in UTF-8 if it has characters that windows-1252 has not or elsewhere."""
    return F.when(F.rlike(text, F.lit(r"[^\x{0}-\x{7F}\x{A0}-\x{FF}]")), F.encode(given, "UTF-8")).otherwise(F.encode(text, "ISO-8859-1"))


def _read_back(files, written):
    """``(path, status, chars, sha)`` of the texts of ``(path, body)`` written in each charset."""
    kinds = F.array(*[F.struct(F.lit(name).alias("charset"), body.alias("bytes")) for name, body in written.items()])
    bare = F.regexp_replace("path", r"\.\w+$", "")
    raw = files.select(bare.alias("file"), F.explode(kinds).alias("k")).select(
        F.concat("file", F.lit("/"), F.replace("k.charset", F.lit("."), F.lit(""))).alias("path"), F.col("k.bytes").alias("body")
    )
    read = parse.extract_text(raw)
    return read.select("path", "status", F.length("body").alias("chars"), F.sha2("body", 256).alias("sha"))


# Spellings that the given pages do not have; %d stands for the page.
HARD_PAGE = (
    "<html><head><script>var s = '</head><meta name=\"author\" content=\"no\">';</script><!-- <title>no</title> -->"
    "<title lang='x'>Tom &amp; Jerry</title></head><body><meta content='A. B.' name=author>"
    '<META data-x="1" NAME = "Keywords" CONTENT = "k1, k2"/><p title="x > y" class=\'a"b\'>%d a &gt; b &#233; &uuml; &szlig; '
    "&#x20AC; &#28450; &amp; &unknown; &amp;lt; x<img alt='1 > 0' src=y> caf&eacute;</p> end %d</body></html>"
)


@query
def extract_hard(spark, sf_dir):
    """A page with unusual spellings for every given page: text and metadata."""
    page_id = F.col("page_id").cast("string")
    hard = X.table(spark, sf_dir, "pages").select("page_id", F.replace(F.lit(HARD_PAGE), F.lit("%d"), page_id).alias("html"))
    found = parse.html_metadata(hard)
    return found.select("page_id", html_text(F.col("html")).alias("body"), "title", "author", "keywords", "description")


@query
def html_metadata(spark, sf_dir):
    found = parse.html_metadata(X.table(spark, sf_dir, "pages"))
    return found.select("page_id", "title", *parse.META_NAMES)


@query
def parse_stats(spark, sf_dir):
    """One handler that fails on long texts, so that all states occur."""

    def handlers():
        def read(path, body):
            if len(body) > 400:
                raise ValueError("too long for this reader")
            return body.decode()

        return {"docx": read}

    short = X.docs(spark, sf_dir).select(F.concat("path", F.lit(".pdf")).alias("path"), F.encode("body", "UTF-8").alias("body"))
    raw = X.raw_files(spark, sf_dir, X.docs, X.turns).select("path", "body").unionByName(short)
    return parse.parse_stats(parse.extract_text(raw, handlers))


# --- scalar functions --------------------------------------------------------------


def _windows_paths(spark, sf_dir):
    """Every document twice: its path as it is, and with backslashes below a dotted folder."""
    both = F.array(F.col("path"), F.concat(F.lit("C:\\v1.2"), F.translate("path", "/", "\\")))
    return X.docs(spark, sf_dir).select(F.explode(both).alias("path"))


@query
def file_name(spark, sf_dir):
    return _windows_paths(spark, sf_dir).select("path", P.file_name(F.col("path")).alias("name"))


@query
def file_extension(spark, sf_dir):
    return _windows_paths(spark, sf_dir).select("path", P.file_extension(F.col("path")).alias("extension"))


@query
def doc_id_hash(spark, sf_dir):
    return _windows_paths(spark, sf_dir).select("path", P.doc_id(F.col("path")).alias("id"))


@query
def path_words(spark, sf_dir):
    return _windows_paths(spark, sf_dir).select("path", P.path_words(F.col("path")).alias("words"))


@query
def result_link(spark, sf_dir):
    return _windows_paths(spark, sf_dir).select("path", P.result_link(F.col("path")).alias("link"))


@query
def date_text(spark, sf_dir):
    when = F.when(F.col("event_type") != "error", F.col("ts"))
    return X.table(spark, sf_dir, "events").select("event_id", P.date_text(when).alias("day"))


# --- languages ---------------------------------------------------------------------


@query
def lang_profiles(spark, sf_dir):
    return language.profiles(X.docs(spark, sf_dir).select("body", "lang"))


@query
def detect_lang(spark, sf_dir):
    return X.language_model(spark, sf_dir).detect(X.texts(spark, sf_dir))


@query
def detect_lang_gated(spark, sf_dir):
    return X.language_model(spark, sf_dir).detect(X.texts(spark, sf_dir), min_margin=language.GATE)


@query
def detect_lang_repeated(spark, sf_dir):
    """All documents twice: each row gets its own verdict."""
    texts = X.texts(spark, sf_dir)
    found = X.language_model(spark, sf_dir).detect(texts.union(texts), min_margin=language.GATE)
    return found.groupBy("path", "lang").agg(F.count(F.lit(1)).alias("n"))


@query
def lang_confusion(spark, sf_dir):
    """Right and wrong verdicts, those on the training set apart."""
    found = X.language_model(spark, sf_dir).detect(X.texts(spark, sf_dir), min_margin=language.GATE)
    labels = X.table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("trained")).distinct()
    truth = X.docs(spark, sf_dir).select("path", "doc_id", F.col("lang").alias("truth")).join(labels, "doc_id", "left")
    trained = F.coalesce("trained", F.lit(False)).alias("trained")
    return found.join(truth, "path").groupBy("truth", F.col("lang").alias("found"), trained).agg(F.count(F.lit(1)).alias("n"))


# --- learned -----------------------------------------------------------------------


@query
def hashing_tf(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    counted = clustering.hashing_tf().transform(words.tokenize(X.texts(spark, sf_dir)))
    total = F.aggregate(vector_to_array("rawFeatures"), F.lit(0.0), lambda a, b: a + b)
    return counted.select("path", F.size("words").alias("n_words"), total.cast("long").alias("tf_sum"))


def _clusters(spark, sf_dir):
    """The fitted model and the clusters of the documents."""
    return X.once(spark, sf_dir, "clusters", lambda: clustering.fit_assign(X.texts(spark, sf_dir)))


@query
def cluster_documents(spark, sf_dir):
    """Every document with whether the centre of its cluster is the nearest one."""
    model, clusters = _clusters(spark, sf_dir)
    return clustering.is_nearest(model, X.texts(spark, sf_dir), clusters)


@query
def cluster_sizes(spark, sf_dir):
    sizes = clustering.cluster_sizes(_clusters(spark, sf_dir)[1])
    return sizes.agg(
        F.sum("documents").alias("documents"),
        F.count_if((F.col("cluster") < 0) | (F.col("cluster") >= clustering.CLUSTERS)).alias("unknown"),
        (F.count(F.lit(1)) > 1).alias("several"),
    )


@query
def cluster_centers(spark, sf_dir):
    weights = clustering.centers(_clusters(spark, sf_dir)[0], X.texts(spark, sf_dir))
    finite = F.bool_and(~F.isnan("weight") & (F.abs("weight") < float("inf")) & (F.col("weight") >= 0))
    return weights.groupBy("cluster").agg(F.count_distinct("dim").alias("dims"), finite.alias("finite"))


@query
def cluster_terms(spark, sf_dir):
    return clustering.top_terms(words.tokenize(X.texts(spark, sf_dir)), X.cluster_table(spark, sf_dir))


@query
def model_reload(spark, sf_dir):
    """A model saved and loaded gives every document the cluster it had."""
    path = scratch_path(spark, "model")
    model, clusters = _clusters(spark, sf_dir)
    clustering.save_model(model, path)
    again = clustering.assign(clustering.load_model(path), X.texts(spark, sf_dir))
    both = clusters.join(again.withColumnRenamed("cluster", "again"), "path")
    return both.select("path", (F.col("cluster") == F.col("again")).alias("same"))


@query
def assign_cluster(spark, sf_dir):
    vectors = X.table(spark, sf_dir, "embeddings")
    means = clustering.mean_centers(vectors, "embedding", "label")
    return vectors.select("vec_id", clustering.nearest_center(F.col("embedding"), means).alias("cluster"))


# --- search ------------------------------------------------------------------------


@query
def postings(spark, sf_dir):
    built = X.index(spark, sf_dir)
    # The smaller side is hashed: the postings are not sorted by document for it.
    ids = built.documents.select(F.col("num").alias("doc"), "id").hint("shuffle_hash")
    return built.postings.join(ids, "doc").select(
        "field",
        "term",
        "id",
        "tf",
        "dl",
        F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions"),
    )


@query
def search_terms(spark, sf_dir):
    return search.hits(X.index(spark, sf_dir), TERMS)


@query
def search_phrase(spark, sf_dir):
    return search.hits(X.index(spark, sf_dir), PHRASE)


@query
def search_proximity(spark, sf_dir):
    return search.hits(X.index(spark, sf_dir), NEAR)


@query
def search_page(spark, sf_dir):
    return search.search(X.index(spark, sf_dir), TERMS, start=20, rows=30, columns=["path", "lang"])


@query
def search_after_update(spark, sf_dir):
    """Labelled documents get other words, and every document comes once more under a new path; then the index is searched."""
    built = index.Index.build(X.index_rows(spark, sf_dir), scratch_path(spark, "updated"), 8, 1)
    labels = X.table(spark, sf_dir, "labels").select("doc_id").distinct()
    docs = X.docs(spark, sf_dir).select("doc_id", "path", "body", "lang")
    changed = docs.join(labels, "doc_id").withColumn("body", F.replace("body", F.lit(" the "), F.lit(" updated ")))
    new = docs.select("doc_id", F.concat("path", F.lit(".new")).alias("path"), "body", "lang")
    batch = changed.unionByName(new).select("path", "body", "lang")
    rows = index.index_documents(parse.with_file_facts(batch), use_parsed_lang=True)
    return search.hits(built.update(rows), "updated the of")


@query
def search_weighted(spark, sf_dir):
    boost = F.when(F.col("lang") == "fr", F.lit(0.5)).otherwise(F.lit(0.0))
    return search.hits(
        X.index(spark, sf_dir), 'src1 "of the"', boost=boost, field_weights={"path": 3.0}, phrase_boost=2.0
    )


@query
def search_match_all(spark, sf_dir):
    return search.hits(X.index(spark, sf_dir), "", filters=[F.col("cluster") >= 0], keep=["cluster"])


@query
def search_faceted(spark, sf_dir):
    return search.search_facets(
        X.index(spark, sf_dir), TERMS, ["lang", "extension", "cluster"], filters=[F.col("lang") != "es"], mincount=2
    )


@query
def highlight(spark, sf_dir):
    """Every hit shown, not just a page of them."""
    built = X.index(spark, sf_dir)
    text = "of src3"
    found = search.search(built, text, rows=None)
    return search.highlight(found, search.query_terms(built, text))


@query
def spell_suggest(spark, sf_dir):
    return spelling.suggest(X.index(spark, sf_dir).terms, MISSPELT)


@query
def spell_corrected(spark, sf_dir):
    """The query of misspelt words, rebuilt."""
    text = " ".join(MISSPELT)
    rebuilt = spelling.corrected(text, spelling.suggest(X.index(spark, sf_dir).terms, MISSPELT))
    return spark.createDataFrame([(text, rebuilt)], "query string, corrected string")


# --- facets ------------------------------------------------------------------------


@query
def facet_field(spark, sf_dir):
    """Two facets: of one status by falling count, and of a prefix with a missing row."""
    orders = X.table(spark, sf_dir, "orders")
    by_priority = facets.facet_field(orders, "o_orderpriority", hit=F.col("o_orderstatus") == "F", limit=3, offset=1)
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    customers = X.table(spark, sf_dir, "customer").select(segment.alias("segment"))
    by_segment = facets.facet_field(customers, "segment", sort="index", prefix="M", mincount=1, missing=True)
    by_size = facets.facet_field(X.table(spark, sf_dir, "part"), "p_size")
    ranked = F.row_number().over(Window.partitionBy("field").orderBy("_order"))
    made = [(by_priority, "priority"), (by_segment, "segment"), (by_size, "size")]
    first, *rest = [f.select("*", F.lit(n).alias("field"), F.monotonically_increasing_id().alias("_order")) for f, n in made]
    for other in rest:
        first = first.unionByName(other)
    return first.select("facet", "count", "field", ranked.alias("rank"))


@query
def facet_array(spark, sf_dir):
    """Language and source of a document as its tags, the language twice."""
    tags = F.when(F.col("n_chars") > 200, F.array("lang", "source", "lang"))
    return facets.facet_field(X.docs(spark, sf_dir).select(tags.alias("tags")), "tags", missing=True)


@query
def facet_range(spark, sf_dir):
    items = X.table(spark, sf_dir, "lineitem")
    return facets.facet_range(items, "l_quantity", 5, 45, 15, other="all", include=["lower", "edge"])


@query
def facet_range_edges(spark, sf_dir):
    items = X.table(spark, sf_dir, "lineitem")
    return facets.facet_range(
        items, "l_quantity", 5, 45, 15, hardend=True, other=["before", "after"], include=["upper", "outer"],
        hit=F.col("l_returnflag") == "R",
    )


@query
def facet_date(spark, sf_dir):
    events = X.table(spark, sf_dir, "events")
    days = facets.facet_date(
        events, "ts", datetime(2023, 12, 30), datetime(2024, 1, 20), 2, "day", other="all", hit=F.col("event_type") == "click"
    )
    orders = X.table(spark, sf_dir, "orders")
    months = facets.facet_date(orders, "o_orderdate", datetime(1995, 1, 1), datetime(1996, 1, 1), 1, "month")
    return days.withColumn("field", F.lit("ts")).unionByName(months.withColumn("field", F.lit("o_orderdate")))


@query
def facet_map(spark, sf_dir):
    counts = facets.facet_field(X.table(spark, sf_dir, "events"), "event_type")
    return facets.from_map(facets.as_map(counts))


@query
def facet_pivot(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders")
    return facets.facet_pivot(orders, "o_orderstatus", "o_orderpriority", totals=True)


@query
def facet_query(spark, sf_dir):
    events = X.table(spark, sf_dir, "events")
    value = F.col("value")
    return facets.facet_query(
        events,
        {"low": value < 5, "middle": facets.in_range(value, 5.0, 50.0, include_high=False), "high": value >= 50},
        hit=F.col("event_type") == "purchase",
    )


@query
def group_top_n(spark, sf_dir):
    docs = X.docs(spark, sf_dir).select("path", "source", "lang", "n_chars")
    return facets.group_top(docs, "source", [F.desc("n_chars"), F.col("path")], rows=3)


QUERIES = {name.rstrip("_"): make for name, make in QUERIES.items()}
