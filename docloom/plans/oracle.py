"""For each registered query the SQL that DuckDB answers on the same tables."""

from __future__ import annotations

from docloom.operators.language import GATE, PROFILE_SIZE
from docloom.operators.parse import HTML_EXTENSIONS, META_NAMES, TEXT_EXTENSIONS
from docloom.plans.queries import CENTER, MISSPELT


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _listed(values) -> str:
    return ", ".join(_quoted(v) for v in values)


W = r"[\p{L}\p{M}\p{N}_]"
_LETTERS = r"[\p{L}\p{M}]+(?:[.:·''’‘][\p{L}\p{M}]+)*"
_DIGITS = r"\p{Nd}+(?:[.,;''’‘]\p{Nd}+)*"
WORD = rf"_*(?:{_LETTERS}|{_DIGITS})(?:{_LETTERS}|{_DIGITS}|_)*"
PATH = (
    "'/' || source || '/' || doc_id || CASE doc_id % 5 WHEN 0 THEN '.txt' WHEN 1 THEN '.TXT' "
    "WHEN 2 THEN '.md' WHEN 3 THEN '.log' ELSE '' END"
)
DOCS = f"(SELECT {PATH} AS path, text AS body, doc_id, lang, source, n_chars FROM documents)"
PAGES = "(SELECT regexp_replace(url, '[?#].*', '') || '/' || page_id || '.html' AS path, html AS body, page_id FROM pages)"
TURNS = "(SELECT '/chat/' || conv_id || '/' || turn || '.docx' AS path, text AS body FROM conversations)"
FILES = f"(SELECT path, body FROM {DOCS} UNION ALL SELECT path, body FROM {PAGES} UNION ALL SELECT path, body FROM {TURNS})"
LANG = f"(SELECT path, d.lang FROM {DOCS} d JOIN labels USING (doc_id))"
CLUSTERS = f"(SELECT path, CAST(label AS INTEGER) AS cluster FROM {DOCS} d JOIN embeddings ON vec_id = doc_id)"
WINDOWS = rf"(SELECT unnest([path, 'C:\v1.2' || translate(path, '/', '\')]) AS path FROM {DOCS})"


def _name(path: str) -> str:
    return rf"regexp_extract({path}, '[^/\\]*$')"


def _extension(path: str) -> str:
    return rf"regexp_extract({_name(path)}, '\.([^.]*)$', 1)"


# The references that the given pages hold; the last one last.
ENTITIES = [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&amp;", "&")]


def _decoded(text: str) -> str:
    for entity, plain in ENTITIES:
        text = f"replace({text}, {_quoted(entity)}, {_quoted(plain)})"
    return text


def _squeezed(text: str) -> str:
    return rf"trim(regexp_replace({text}, '[ \t\n\f\r]+', ' ', 'g'))"


def _html_text(html: str) -> str:
    drop = (
        r"(?is)<script\b[^<>]*>.*?(?:</script\s*>|\z)|<style\b[^<>]*>.*?(?:</style\s*>|\z)"
        r"|<title\b[^<>]*>[^<]*(?:</title\s*>)?|<!--.*?(?:-->|\z)|</?[a-z!?][^<>]*>"
    )
    return _squeezed(_decoded(f"regexp_replace({html}, '{drop}', ' ', 'g')"))


def _found(html: str, pattern: str) -> str:
    head = f"regexp_replace({html}, '(?is)</head\\s*>.*', '')"
    return f"nullif({_squeezed(_decoded(f'regexp_extract({head}, {_quoted(pattern)}, 1)'))}, '')"


def _title(html: str) -> str:
    return _found(html, r"(?i)<title\b[^<>]*>([^<]*)")


def _meta(html: str, name: str) -> str:
    return _found(html, rf'(?i)<meta\s+name="{name}"\s+content="([^"<>]*)"')


def _page_text(html: str) -> str:
    facts = ", ".join([_title(html), *[_meta(html, n) for n in META_NAMES]])
    return f"concat_ws(chr(10), {_html_text(html)}, {facts})"


PARSED = f"""(
    SELECT path, {_name('path')} AS "fileName", extension,
      CASE WHEN lower(extension) IN ({_listed(HTML_EXTENSIONS)}) THEN 'html'
           WHEN lower(extension) IN ({_listed(TEXT_EXTENSIONS)}) THEN 'text' ELSE 'other' END AS route,
      CASE route WHEN 'html' THEN {_page_text('body')} WHEN 'text' THEN body ELSE '' END AS body,
      CASE route WHEN 'other' THEN 'unsupported' ELSE 'ok' END AS status
    FROM (SELECT path, body, {_extension('path')} AS extension FROM {FILES}))"""


# --- languages ---------------------------------------------------------------------


def _grams(source: str, key: str) -> str:
    """``(key, gram, n)`` for ``source(key, body)``."""
    return rf"""
      SELECT {key}, gram, sum(n) AS n FROM (
        SELECT {key}, n, unnest(list_transform(range(1, length(word) + 1), lambda i: substr('_' || word || '_', i, 3))) AS gram
        FROM (SELECT {key}, word, count(*) AS n
              FROM (SELECT {key}, unnest(regexp_extract_all(lower(body), '\p{{L}}+')) AS word FROM {source})
              GROUP BY ALL))
      GROUP BY ALL"""


def _profiles(source: str) -> str:
    return f"""
      SELECT lang, gram, CAST(floor(n * 1e6 / total + 0.5) AS BIGINT) AS pf FROM (
        SELECT lang, gram, n, sum(n) OVER (PARTITION BY lang) AS total,
          row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS place
        FROM ({_grams(source, 'lang')}))
      WHERE place <= {PROFILE_SIZE}"""


def _detected(source: str, margin: float | None) -> str:
    """CTEs ending in ``detected(path, lang)`` for ``source(path, body)``."""
    sure = "letters > 0" if margin is None else f"letters > 0 AND next - d >= {margin * 1e12!r}::DOUBLE"
    return rf"""
      prof AS MATERIALIZED ({_profiles(f"(SELECT body, d.lang FROM {DOCS} d JOIN labels USING (doc_id))")}),
      norms AS (SELECT lang, CAST(sum(pf * pf) AS DOUBLE) AS norm FROM prof GROUP BY lang),
      letters AS (SELECT path, length(regexp_replace(lower(body), '\P{{L}}+', '', 'g')) AS letters FROM {source}),
      sums AS (SELECT path, lang, CAST(sum(pf * n) AS DOUBLE) AS s
               FROM ({_grams(source, 'path')}) g JOIN prof USING (gram) GROUP BY path, lang),
      dist AS (SELECT path, lang, letters, norm - 2e6 * coalesce(s, 0) / letters AS d
               FROM letters CROSS JOIN norms LEFT JOIN sums USING (path, lang)),
      detected AS (
        SELECT path, CASE WHEN {sure} THEN lang ELSE '' END AS lang
        FROM (SELECT *, row_number() OVER o AS place, lead(d) OVER o AS next FROM dist WINDOW o AS (PARTITION BY path ORDER BY d, lang))
        WHERE place = 1)"""


# --- search ------------------------------------------------------------------------



def _tokens(docs: str) -> str:
    """CTEs over ``docs``, a query that gives at least ``id``, ``path`` and ``body``."""
    return rf"""
  docs AS MATERIALIZED ({docs}),
  cut AS (SELECT id, 'text' AS field, regexp_extract_all(lower(body), '{WORD}') AS words FROM docs
          UNION ALL
          SELECT id, 'path', regexp_extract_all(lower(translate(path, './\_', '    ')), '{WORD}') FROM docs),
  tok AS MATERIALIZED (SELECT id, field, len(words) AS dl, unnest(words) AS term,
             unnest(range(len(words))) AS pos FROM cut),
  dfs AS (SELECT field, term, count(DISTINCT id) AS df FROM tok GROUP BY ALL),
  n AS (SELECT count(*) AS n FROM docs),
  lens AS (SELECT field, count(*) / max(n) AS avg_len FROM tok, n GROUP BY field)"""


TOKENS = _tokens(
    f"""SELECT sha256(path) AS id, path, body, lang, {_extension('path')} AS extension, coalesce(cluster, -1) AS cluster
        FROM {DOCS} LEFT JOIN {CLUSTERS} c USING (path)"""
)
# Labelled documents with another word for "the", and every document once more as a new one.
UPDATED = _tokens(
    rf"""SELECT sha256(path) AS id, path, body FROM (
          SELECT path, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN replace(body, ' the ', ' updated ')
                       ELSE body END AS body FROM {DOCS}
          UNION ALL SELECT path || '.new', body FROM {DOCS})"""
)


def _weight(terms: list[str]) -> str:
    """``(field, idf)`` of a clause: the summed weights of its distinct places."""
    each = " UNION ALL ".join(f"SELECT {_quoted(t)} AS term" for t in terms)
    return f"""SELECT field, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))) AS idf
               FROM ({each}) JOIN dfs USING (term), n GROUP BY field"""


def _clause(terms: list[str], slop: int = 0) -> str:
    """``(id, field, part)`` of one clause, ``part`` being its BM25 score."""
    if len(terms) == 1:
        tf = f"SELECT id, field, dl, count(*) AS tf FROM tok WHERE term = {_quoted(terms[0])} GROUP BY ALL"
    else:
        starts = " UNION ALL ".join(
            f"SELECT id, field, dl, {i} AS i, pos - {i} AS start FROM tok WHERE term = {_quoted(t)}"
            for i, t in enumerate(terms)
        )
        reached = " AND ".join(
            f"EXISTS (SELECT 1 FROM s s{i} WHERE s{i}.id = s.id AND s{i}.field = s.field AND s{i}.i = {i} "
            f"AND s{i}.start BETWEEN s.start AND s.start + {slop})"
            for i in range(len(terms))
        )
        for term in {t for t in terms if slop and terms.count(t) > 1}:
            at = [i for i, t in enumerate(terms) if t == term]
            reached += (
                f" AND (SELECT count(DISTINCT x.start + x.i) FROM s x WHERE x.id = s.id AND x.field = s.field "
                f"AND x.i IN ({', '.join(map(str, at))}) AND x.start BETWEEN s.start AND s.start + {slop}) >= {len(at)}"
            )
        tf = f"""SELECT id, field, dl, count(DISTINCT start) AS tf
                 FROM (WITH s AS MATERIALIZED ({starts}) SELECT * FROM s WHERE {reached}) GROUP BY ALL"""
    return f"""SELECT id, field, {len(terms)} AS words,
                 idf * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avg_len)) AS part
               FROM ({tf}) JOIN ({_weight(terms)}) USING (field) JOIN lens USING (field)"""


def _scores(*clauses, part: str = "part") -> str:
    parts = " UNION ALL ".join(f"({_clause(*c)})" for c in clauses)
    return f"(SELECT id, sum({part}) AS raw FROM ({parts}) GROUP BY id)"


SEARCH = _scores((["le"],), (["of"],), (["der"],))


def _marked(text: str, terms: list[str]) -> str:
    pieces = rf"regexp_extract_all({text}, '{W}+|[^\p{{L}}\p{{M}}\p{{N}}_]+')"
    return (
        f"array_to_string(list_transform({pieces}, lambda x: CASE WHEN lower(x) IN ({_listed(terms)}) "
        "THEN '<span class=''highlight''>' || x || '</span>' ELSE x END), '')"
    )


def _fragment(text: str, terms: list[str]) -> str:
    pieces = rf"regexp_extract_all({text}, '{W}+|[^\p{{L}}\p{{M}}\p{{N}}_]+')"
    first = f"list_position(list_transform({pieces}, lambda x: lower(x) IN ({_listed(terms)})), true)"
    before = f"length(array_to_string(list_slice({pieces}, 1, {first} - 1), ''))"
    start = f"CAST(greatest(1, {before} + 1 - 250) AS BIGINT)"
    cut = f"substr({text}, {start}, 500)"
    cut = f"CASE WHEN {start} > 1 AND regexp_matches(substr({text}, {start} - 1, 1), '{W}') THEN regexp_replace({cut}, '^{W}+', '') ELSE {cut} END"
    cut = f"CASE WHEN regexp_matches(substr({text}, {start} + 500, 1), '{W}') THEN regexp_replace({cut}, '{W}+$', '') ELSE {cut} END"
    return f"CASE WHEN {first} > 0 THEN {cut} END"


# --- facets ------------------------------------------------------------------------


def _ranges(facets: list[tuple[str, str]], table: str, hit: str = "true") -> str:
    return " UNION ALL ".join(
        f"SELECT {_quoted(name)} AS facet, count(*) FILTER ({condition} AND {hit}) AS count FROM {table}"
        for name, condition in facets
    )


def _span(column: str, low, high, left: str = ">=", right: str = "<") -> str:
    return f"{column} {left} {low} AND {column} {right} {high}"


def _days() -> str:
    ends = [f"TIMESTAMP '2023-12-30' + INTERVAL {2 * i} DAY" for i in range(12)]
    facets = " UNION ALL ".join(
        f"SELECT strftime({low}, '%Y-%m-%dT%H:%M:%S') AS facet, {low} AS low, {high} AS high" for low, high in zip(ends, ends[1:])
    )
    return f"""SELECT facet, (SELECT count(*) FROM events WHERE event_type = 'click' AND ts >= low AND ts < high) AS count, 'ts' AS field
               FROM ({facets}
                 UNION ALL SELECT 'before', TIMESTAMP '1000-01-01', {ends[0]}
                 UNION ALL SELECT 'after', {ends[-1]}, TIMESTAMP '9000-01-01'
                 UNION ALL SELECT 'between', {ends[0]}, {ends[-1]})"""


def _months() -> str:
    return """SELECT strftime(m, '%Y-%m-%dT%H:%M:%S') AS facet,
                (SELECT count(*) FROM orders WHERE date_trunc('month', o_orderdate) = m) AS count, 'o_orderdate' AS field
              FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '1995-12-01', INTERVAL 1 MONTH)) AS m)"""


LAT, LNG = "radians(CAST(c_custkey % 181 - 90 AS DOUBLE))", "radians(CAST(c_custkey % 361 - 180 AS DOUBLE))"
TO_LAT, TO_LNG = (f"radians({v!r}::DOUBLE)" for v in CENTER)
TURN = f"(CASE WHEN {LNG} - {TO_LNG} < -pi() THEN {LNG} - {TO_LNG} + 2 * pi() ELSE {LNG} - {TO_LNG} END)"
ARC = f"acos(least(1, sin({LAT}) * sin({TO_LAT}) + cos({LAT}) * cos({TO_LAT}) * cos({TURN})))"
FLAT = f"sqrt(pow({TURN} * cos(({LAT} + {TO_LAT}) / 2), 2) + pow({LAT} - {TO_LAT}, 2))"

ORACLE: dict[str, str] = {
    "scan_files": """
        SELECT source, '' AS lang, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes, count(*) AS lines, count(DISTINCT line) AS distinct_lines
        FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY source""",
    "refuse_existing": f"SELECT path, lang, true AS refused FROM {DOCS}",
    "sql_functions": rf"""
        SELECT path, {_name('path')} AS name, {_extension('path')} AS extension, sha256(path) AS id,
          regexp_replace(path, '[./\\_]', ' ', 'g') AS words, CAST(len(regexp_extract_all(body, '{WORD}')) AS INTEGER) AS n_words
        FROM {DOCS}""",
    "blacklist_filter": f"""
        SELECT path || CASE lang WHEN 'fr' THEN '/Thumbs.db.txt' ELSE '' END AS path, n_chars
        FROM {DOCS} WHERE lang NOT IN ('es', 'de')""",
    "expand_archives": f"""
        SELECT path || unnest(['.ZIP/folder/text.txt', '.ZIP/inner.zip/copy.md']) AS path, '' AS lang, 'ok' AS status,
          CAST(strlen(body) AS INTEGER) AS bytes, sha256(body) AS sha FROM {DOCS}
        UNION ALL SELECT path, '', 'ok', CAST(strlen(body) AS INTEGER), sha256(body) FROM {PAGES}""",
    "large_archives": f"""
        SELECT path, 'ok' AS status, CAST(strlen(body) AS INTEGER) AS bytes, sha256(body) AS sha FROM {DOCS}""",
    "pack_files": f"""
        SELECT path, '' AS lang, CAST(strlen(body) AS INTEGER) AS bytes, sha256(body) AS sha FROM {DOCS}
        UNION ALL SELECT path, '', CAST(strlen(body) AS INTEGER), sha256(body) FROM {PAGES}""",
    "catalog_join": f"""
        SELECT cluster, l.lang, count(*) AS documents, CAST(sum(w.d) AS BIGINT) AS distinct_words, CAST(sum(w.n) AS BIGINT) AS words
        FROM (SELECT path, len(list_distinct(t)) AS d, len(t) AS n
              FROM (SELECT path, regexp_extract_all(body, '{WORD}') AS t FROM {DOCS}) WHERE len(t) > 0) w
        JOIN {LANG} l USING (path) JOIN {CLUSTERS} c USING (path) GROUP BY cluster, l.lang""",
    "index_upsert": f"""
        SELECT sha256(path) AS id, path, coalesce(l.lang, '') AS lang, -1 AS cluster, CAST(length(body) AS INTEGER) AS chars
        FROM {DOCS} d LEFT JOIN {LANG} l USING (path)""",
    "parse_documents": f"""
        WITH files AS MATERIALIZED (SELECT * FROM {PARSED}), {_detected('files', GATE)}
        SELECT path, "fileName", extension, detected.lang, CAST(length(body) AS INTEGER) AS chars, sha256(body) AS sha
        FROM files JOIN detected USING (path)""",
    "index_defaults": f"""
        SELECT path, {_name('path')} AS "fileName", {_extension('path')} AS extension, '' AS lang, -1 AS cluster,
          CAST(length(body) AS INTEGER) AS chars FROM {DOCS}""",
    "index_documents": f"""
        SELECT sha256(path) AS id, path, {_name('path')} AS "fileName", l.lang, body AS text, {_extension('path')} AS extension, cluster,
          CASE WHEN l.lang = 'fr' THEN body END AS text_fr, CASE WHEN l.lang = 'en' THEN body END AS text_en
        FROM {DOCS} d JOIN {LANG} l USING (path) JOIN {CLUSTERS} c USING (path)""",
    "join_lang": f"""
        SELECT path, {_name('path')} AS "fileName", {_extension('path')} AS extension, l.lang, -1 AS cluster
        FROM {DOCS} d JOIN {LANG} l USING (path)""",
    "join_cluster": f"""
        SELECT path, {_name('path')} AS "fileName", {_extension('path')} AS extension, '' AS lang, coalesce(cluster, -1) AS cluster
        FROM {DOCS} d LEFT JOIN {CLUSTERS} c USING (path)""",
    "rescue_filter": f"""
        SELECT path || '.Pdf' AS path, CAST(length(body) AS INTEGER) AS chars, sha256(body) AS sha
        FROM {DOCS} WHERE lang = 'fr' AND contains(body, chr(10))""",
    "extension_route": f"""
        SELECT CASE WHEN lower(extension) IN ({_listed(HTML_EXTENSIONS)}) THEN 'html'
                    WHEN lower(extension) IN ({_listed(TEXT_EXTENSIONS)}) THEN 'text' ELSE 'other' END AS route,
          extension, count(*) AS files, count(*) FILTER (lower(extension) IN ('txt', 'docx')) AS txt_or_docx
        FROM (SELECT {_extension('path')} AS extension FROM {FILES}) GROUP BY ALL""",
    "lang_routing": f"""
        SELECT path, CASE WHEN n_chars > 1000 THEN upper(lang) ELSE lang END AS lang,
          CASE lang WHEN 'fr' THEN sha256(body) END AS sha_fr,
          CASE lang WHEN 'en' THEN sha256(body) END AS sha_en FROM {DOCS}""",
    "filter_query": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority NOT IN ('1-URGENT', '5-LOW')""",
    "range_filter": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
        WHERE l_quantity >= 10 AND l_quantity < 20 AND l_discount > 0.02::DOUBLE""",
    "geo_radius": f"""
        SELECT c_custkey, round(6371 * {ARC}, 3) AS km, round(3958.8::DOUBLE * {FLAT}, 3) AS flat_miles
        FROM customer WHERE 6371 * {ARC} <= 3000""",
    "tokenize": f"""
        SELECT path, CAST(len(t) AS INTEGER) AS n, array_to_string(t, ' ') AS words
        FROM (SELECT path, regexp_extract_all(body, '{WORD}') AS t FROM {DOCS})""",
    "shingles": f"""
        SELECT path, CAST(len(s) AS INTEGER) AS n, sha256(array_to_string(s, '|')) AS sha FROM (
          SELECT path, t || list_transform(range(1, greatest(len(t), 1)), lambda i: t[i] || ' ' || t[i + 1])
            || list_transform(range(1, greatest(len(t) - 1, 1)), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) AS s
          FROM (SELECT path, regexp_extract_all(body, '{WORD}') AS t FROM {DOCS}))""",
    "wordcount": f"""
        SELECT f, w, count(*) AS c FROM (SELECT path AS f, unnest(regexp_extract_all(body, '{WORD}')) AS w FROM {DOCS})
        GROUP BY f, w""",
    "doc_freq": f"""
        SELECT w, count(DISTINCT f) AS df
        FROM (SELECT path AS f, unnest(regexp_extract_all(body, '{WORD}')) AS w FROM {DOCS}) GROUP BY w""",
    "tfidf": f"""
        WITH wc AS MATERIALIZED (SELECT f, w, count(*) AS c
          FROM (SELECT path AS f, unnest(regexp_extract_all(body, '{WORD}')) AS w FROM {DOCS}) GROUP BY f, w),
        dfs AS (SELECT w, count(*) AS df FROM wc GROUP BY w), n AS (SELECT count(*) AS n FROM documents)
        SELECT f, w, c, df, round(c * ln((n + 1::DOUBLE) / (df + 1::DOUBLE)), 6) AS tfidf FROM wc JOIN dfs USING (w), n""",
    "extract_html": f"""
        SELECT path, "fileName", extension, status, body FROM {PARSED} WHERE route = 'html'""",
    "extract_text": f"""
        SELECT path, extension, status, CAST(length(body) AS INTEGER) AS chars, sha256(body) AS sha FROM {PARSED}""",
    "charset_documents": rf"""
        SELECT regexp_replace(path, '\.\w+$', '') || '/' || c AS path, 'ok' AS status, CAST(length(body) AS INTEGER) AS chars, sha256(body) AS sha
        FROM {DOCS}, unnest(['utf-8', 'utf-16le', 'utf-16be']) AS u(c)""",
    "charset_pages": rf"""
        SELECT regexp_replace(path, '\.\w+$', '') || '/' || c AS path, status, CAST(length(body) AS INTEGER) AS chars, sha256(body) AS sha
        FROM {PARSED}, unnest(['utf-8', 'iso-8859-1', 'utf-16le', 'utf-16be']) AS u(c) WHERE route = 'html'""",
    "extract_hard": """
        SELECT page_id, page_id || ' a > b é ü ß € 漢 & &unknown; &lt; x caf' || chr(233) || ' end ' || page_id AS body,
          'Tom & Jerry' AS title, 'A. B.' AS author, 'k1, k2' AS keywords, NULL AS description FROM pages""",
    "html_metadata": f"""
        SELECT page_id, {_title('html')} AS title, {", ".join(f"{_meta('html', n)} AS {n}" for n in META_NAMES)} FROM pages""",
    "parse_stats": """
        SELECT 'ok' AS status, (SELECT count(*) FROM documents) + (SELECT count(*) FROM conversations WHERE strlen(text) <= 400) AS files
        UNION ALL SELECT 'error', (SELECT count(*) FROM conversations WHERE strlen(text) > 400)
        UNION ALL SELECT 'unsupported', (SELECT count(*) FROM documents)""",
    "file_name": f"SELECT path, {_name('path')} AS name FROM {WINDOWS}",
    "file_extension": f"SELECT path, {_extension('path')} AS extension FROM {WINDOWS}",
    "doc_id_hash": f"SELECT path, sha256(path) AS id FROM {WINDOWS}",
    "path_words": rf"SELECT path, regexp_replace(path, '[./\\_]', ' ', 'g') AS words FROM {WINDOWS}",
    "result_link": rf"SELECT path, 'file://' || replace(path, '\', '/') AS link FROM {WINDOWS}",
    "date_text": """
        SELECT event_id, CASE event_type WHEN 'error' THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events""",
    "lang_profiles": _profiles(DOCS),
    "detect_lang": f"WITH {_detected(DOCS, None)} SELECT path, lang FROM detected",
    "detect_lang_gated": f"WITH {_detected(DOCS, GATE)} SELECT path, lang FROM detected",
    "detect_lang_repeated": f"WITH {_detected(DOCS, GATE)} SELECT path, lang, 2::BIGINT AS n FROM detected",
    "lang_confusion": f"""
        WITH {_detected(DOCS, GATE)}
        SELECT t.lang AS truth, d.lang AS found, t.doc_id IN (SELECT doc_id FROM labels) AS trained, count(*) AS n
        FROM detected d JOIN {DOCS} t USING (path) GROUP BY ALL""",
    "hashing_tf": f"""
        SELECT path, CAST(len(t) AS INTEGER) AS n_words, CAST(len(t) AS BIGINT) AS tf_sum
        FROM (SELECT path, regexp_extract_all(body, '{WORD}') AS t FROM {DOCS})""",
    "cluster_documents": f"SELECT path, true AS nearest FROM {DOCS}",
    "cluster_sizes": "SELECT count(*) AS documents, 0::BIGINT AS unknown, true AS several FROM documents",
    "cluster_centers": "SELECT CAST(unnest(range(20)) AS INTEGER) AS cluster, 1000::BIGINT AS dims, true AS finite",
    "cluster_terms": f"""
        WITH wc AS MATERIALIZED (SELECT f, w, count(*) AS n
          FROM (SELECT path AS f, unnest(regexp_extract_all(body, '{WORD}')) AS w FROM {DOCS}) GROUP BY f, w),
        dfs AS (SELECT w, count(*) AS df FROM wc GROUP BY w), docs AS (SELECT count(*) AS docs FROM documents),
        own AS (SELECT cluster, w, CAST(sum(n) AS BIGINT) AS c FROM wc JOIN {CLUSTERS} ON path = f GROUP BY cluster, w),
        scored AS (SELECT cluster, w, c, round(c * ln((docs + 1::DOUBLE) / (df + 1::DOUBLE)), 6) AS weight FROM own JOIN dfs USING (w), docs)
        SELECT cluster, CAST(row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, w) AS INTEGER) AS rank, w, c, weight
        FROM scored QUALIFY rank <= 10""",
    "model_reload": f"SELECT path, true AS same FROM {DOCS}",
    "assign_cluster": """
        WITH parts AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(len(embedding))) AS dim FROM embeddings),
        means AS (SELECT label AS cluster, dim, avg(CAST(x AS DOUBLE)) AS m FROM parts GROUP BY ALL),
        dist AS (SELECT vec_id, cluster, sum((x - m) * (x - m)) AS d FROM parts JOIN means USING (dim) GROUP BY ALL)
        SELECT vec_id, CAST(arg_min(cluster, d) AS INTEGER) AS cluster FROM dist GROUP BY vec_id""",
    "postings": f"""
        WITH {TOKENS}
        SELECT field, term, id, count(*) AS tf, CAST(dl AS INTEGER) AS dl, string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS positions
        FROM tok GROUP BY field, term, id, dl""",
    "search_terms": f"WITH {TOKENS} SELECT id, round(raw, 6) AS score FROM {SEARCH}",
    "search_after_update": f"""
        WITH {UPDATED} SELECT id, round(raw, 6) AS score FROM {_scores((["updated"],), (["the"],), (["of"],))}""",
    "search_phrase": f"""
        WITH {TOKENS} SELECT id, round(raw, 6) AS score FROM {_scores((["of", "the"],), (["de", "la"],))}""",
    "search_proximity": f"""
        WITH {TOKENS} SELECT id, round(raw, 6) AS score FROM {_scores((["the", "of"], 3), (["the", "of", "the"], 3))}""",
    "search_page": f"""
        WITH {TOKENS} SELECT id, round(raw, 6) AS score, path, lang FROM {SEARCH} JOIN docs USING (id)
        ORDER BY score DESC, id LIMIT 30 OFFSET 20""",
    "search_weighted": f"""
        WITH {TOKENS} SELECT id, round(round(raw, 6) + CASE lang WHEN 'fr' THEN 0.5::DOUBLE ELSE 0::DOUBLE END, 6) AS score
        FROM {_scores((["src1"],), (["of", "the"],), part="part * CASE field WHEN 'path' THEN 3 ELSE 1 END * CASE WHEN words > 1 THEN 2 ELSE 1 END")}
        JOIN docs USING (id)""",
    "search_match_all": f"""
        WITH {TOKENS} SELECT id, 0::DOUBLE AS score, cluster FROM docs WHERE cluster >= 0""",
    "search_faceted": f"""
        WITH {TOKENS}, found AS MATERIALIZED (SELECT * FROM {SEARCH} JOIN docs USING (id) WHERE lang <> 'es')
        SELECT lang AS facet, count(*) AS count, 'lang' AS field FROM found GROUP BY lang HAVING count(*) >= 2
        UNION ALL SELECT extension, count(*), 'extension' FROM found GROUP BY extension HAVING count(*) >= 2
        UNION ALL SELECT CAST(cluster AS VARCHAR), count(*), 'cluster' FROM found GROUP BY cluster HAVING count(*) >= 2""",
    "highlight": f"""
        WITH {TOKENS}
        SELECT id, path, round(raw, 6) AS score,
          coalesce('...' || {_marked(_fragment('body', ['of', 'src3']), ['of', 'src3'])} || '...', '') AS snippet,
          CASE WHEN {_marked('path', ['of', 'src3'])} <> path THEN {_marked('path', ['of', 'src3'])} ELSE id END AS title,
          'file://' || path AS link
        FROM {_scores((["of"],), (["src3"],))} JOIN docs USING (id)""",
    "spell_suggest": f"""
        WITH {TOKENS}, known AS (SELECT term, sum(df) AS df FROM dfs GROUP BY term),
        near AS (SELECT word, term, df, levenshtein(term, word) AS distance
                 FROM known, (SELECT unnest([{_listed(MISSPELT)}]) AS word)
                 WHERE abs(length(term) - length(word)) <= 2 AND levenshtein(term, word) <= 2)
        SELECT word, term AS suggestion, CAST(distance AS INTEGER) AS distance, CAST(df AS BIGINT) AS df
        FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY distance, df DESC, term) AS place FROM near)
        WHERE place = 1 AND distance > 0""",
    "facet_array": """
        SELECT tag AS facet, count(*) AS count FROM (SELECT unnest([lang, source]) AS tag FROM documents WHERE n_chars > 200) GROUP BY tag
        UNION ALL SELECT NULL, count(*) FROM documents WHERE NOT n_chars > 200""",
    "facet_field": """
        (SELECT o_orderpriority AS facet, count(*) FILTER (o_orderstatus = 'F') AS count, 'priority' AS field,
           CAST(row_number() OVER (ORDER BY count(*) FILTER (o_orderstatus = 'F') DESC, o_orderpriority) - 1 AS INTEGER) AS rank
         FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3 OFFSET 1)
        UNION ALL
        (SELECT c_mktsegment, count(*), 'segment', CAST(row_number() OVER (ORDER BY c_mktsegment) AS INTEGER)
         FROM customer WHERE c_acctbal >= 0 AND c_mktsegment LIKE 'M%' GROUP BY 1)
        UNION ALL
        (SELECT NULL, count(*), 'segment', CAST(1 + (SELECT count(DISTINCT c_mktsegment) FROM customer
                                                     WHERE c_acctbal >= 0 AND c_mktsegment LIKE 'M%') AS INTEGER)
         FROM customer WHERE NOT c_acctbal >= 0)
        UNION ALL
        (SELECT CAST(p_size AS VARCHAR), count(*), 'size', CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(p_size AS VARCHAR)) AS INTEGER)
         FROM part GROUP BY p_size)""",
    "facet_range": _ranges(
        [
            ("5.0", _span("l_quantity", 5, 20)),
            ("20.0", _span("l_quantity", 20, 35)),
            ("35.0", _span("l_quantity", 35, 50, right="<=")),
            ("before", "l_quantity < 5"),
            ("after", "l_quantity > 50"),
            ("between", _span("l_quantity", 5, 50, right="<=")),
        ],
        "lineitem",
    ),
    "facet_range_edges": _ranges(
        [
            ("5.0", _span("l_quantity", 5, 20, ">", "<=")),
            ("20.0", _span("l_quantity", 20, 35, ">", "<=")),
            ("35.0", _span("l_quantity", 35, 45, ">", "<=")),
            ("before", "l_quantity <= 5"),
            ("after", "l_quantity >= 45"),
        ],
        "lineitem",
        "l_returnflag = 'R'",
    ),
    "facet_date": f"{_days()} UNION ALL {_months()}",
    "facet_map": "SELECT event_type AS facet, count(*) AS count FROM events GROUP BY event_type",
    "facet_pivot": """
        SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
    "facet_query": """
        SELECT facet, count(*) FILTER (event_type = 'purchase' AND value >= low AND value < high) AS count
        FROM events, (VALUES ('low', -1e9, 5), ('middle', 5, 50), ('high', 50, 1e9)) v(facet, low, high) GROUP BY facet""",
    "group_top_n": f"""
        SELECT path, source, lang, n_chars, CAST(place AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, path) AS place FROM {DOCS}) WHERE place <= 3""",
}

ORACLE["spell_corrected"] = f"""
    WITH suggested AS ({ORACLE['spell_suggest']}),
    asked AS (SELECT unnest([{_listed(MISSPELT)}]) AS word, unnest(range({len(MISSPELT)})) AS place)
    SELECT string_agg(word, ' ' ORDER BY place) AS query, string_agg(coalesce(suggestion, word), ' ' ORDER BY place) AS corrected
    FROM asked LEFT JOIN suggested USING (word)"""
