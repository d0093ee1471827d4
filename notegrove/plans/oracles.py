"""The SQL counterparts of the catalog, for a second engine over the same tables."""

from __future__ import annotations

# --- Shared pieces ---


def tokens(col: str, pattern: str = r"[\p{L}\p{N}]+(?:[''’][\p{L}\p{N}]+)*") -> str:
    return f"regexp_extract_all(lower({col}), '{pattern}')"



def lettered(col: str) -> str:
    """A lower-case word with every letter one byte: this engine measures distances in
    bytes. Capitals and signs, which no word holds, stand for letters with accents."""
    return f"translate({col}, 'ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ’', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&*+/')"

PEOPLE = """people AS (
  SELECT c_custkey AS id, c_name AS title, c_acctbal AS points, c_mktsegment AS variety,
         n_name AS province, r_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""

PARTS = """parts AS (
  SELECT p_partkey AS id, p_name AS title, p_size AS points, p_retailprice AS price,
         p_type AS variety, p_brand AS winery FROM part)"""

DOCS = """docs AS (
  SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS description,
         n_chars AS points, lang AS country, source AS province,
         CAST(quality AS DOUBLE) AS price
  FROM documents LEFT JOIN labels USING (doc_id))"""

VECS = """vecs AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vector, label AS country,
         80 + vec_id % 21 AS points, CAST(vec_id * 7 % 150 AS DOUBLE) AS price
  FROM embeddings)"""


def index() -> str:
    """``places``: every token with its field, position and field length; ``postings``."""
    tok = tokens("text")
    return f"""texts AS (
  SELECT doc_id AS id, 'title' AS field, split_part(text, chr(10), 1) AS text FROM documents
  UNION ALL SELECT doc_id, 'description', text FROM documents),
words AS (SELECT id, field, {tok} AS toks FROM texts),
places AS (SELECT id, field, len(toks) AS dl, unnest(toks) AS term,
                  generate_subscripts(toks, 1) - 1 AS pos FROM words),
postings AS (SELECT id, field, term, dl, count(*) AS tf FROM places GROUP BY ALL)"""


# --- Ingest ---

# The raw lines' flaws follow from the key and the size; the good rows are the rest.
_GOOD_PARTS = PARTS + """,
raw AS (
  SELECT *, CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN '' ELSE winery END
              AS place
  FROM parts WHERE points NOT BETWEEN 7 AND 15)"""

CLEAN_TEXT = f"""WITH {_GOOD_PARTS}
SELECT id, points, title, CASE WHEN id % 5 <> 0 THEN variety END AS description,
       CASE WHEN id % 3 <> 0 THEN price END AS price, 'Reserve' AS vineyard,
       CASE WHEN place IS NULL OR place = 'null' THEN 'Unknown' ELSE place END AS country,
       'A  B' AS province, 'lot ' || variety AS lot
FROM raw"""

CLEAN_VECTOR = f"""WITH {_GOOD_PARTS}
SELECT id, CASE WHEN place IS NULL OR place = '' THEN 'Unknown' ELSE place END AS country,
       trim(concat_ws(' ', variety, CASE WHEN place <> '' THEN place END, ' A  B' || chr(9),
                      ' ' || chr(9) || title || ' ' || chr(10),
                      CASE WHEN id % 5 <> 0 THEN variety END), ' ' || chr(9) || chr(10))
         AS to_vectorize
FROM raw"""

QUARANTINE = """SELECT CASE WHEN p_size = 9 THEN 'missing:vineyard' WHEN p_size IN (10, 12, 13, 14) THEN 'not_json'
            WHEN p_size = 15 THEN 'type:country' ELSE 'type:points' END AS reason, count(*) AS n
FROM part WHERE p_size BETWEEN 7 AND 15 GROUP BY 1"""

FILL_MISSING = f"""WITH {PARTS},
raw AS (SELECT id, CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN ''
                     ELSE winery END AS place FROM parts)
SELECT id,
       CASE WHEN place IS NULL OR place = 'null' THEN 'Unknown' ELSE place END
         AS keyword_country,
       CASE WHEN place IS NULL OR place = '' THEN 'Unknown' ELSE place END AS vector_country
FROM raw"""

COMPOSE_TEXT = f"""WITH {DOCS}
SELECT id, regexp_replace(concat_ws(' ', CAST(CAST(price AS INTEGER) AS VARCHAR),
         nullif(title, ''), country), '^\\s+|\\s+$', '', 'g') AS text FROM docs"""

CAST_REJECT = f"""WITH {PARTS}
SELECT id, CASE WHEN id % 4 <= 1 THEN CAST(points AS BIGINT) END AS as_int,
       CASE id % 4 WHEN 0 THEN CAST(points AS DOUBLE) WHEN 1 THEN CAST(points AS DOUBLE)
                   WHEN 2 THEN points + CAST(0.5 AS DOUBLE)
                   WHEN 3 THEN CASE WHEN id % 8 = 3 THEN CAST(100 AS DOUBLE) END END AS as_number
FROM parts"""

PRICE_LABEL = """SELECT doc_id AS id, quality AS price,
       coalesce(CAST(quality AS VARCHAR), 'Not available') AS price_label
FROM documents LEFT JOIN labels USING (doc_id)"""

JSONL_ROUNDTRIP = f"""WITH {PARTS}
SELECT id, title, points, price, variety, winery, 'Unknown' AS country FROM parts"""

JSON_ARRAY_IDS = f"""WITH {PARTS}
SELECT row_number() OVER (ORDER BY id) AS id, id AS key, title, points FROM parts"""

REPLAY = f"""WITH {PARTS}
SELECT CAST(replay AS INTEGER) AS replay, count(*) AS n, CAST(sum(points) AS BIGINT) AS points
FROM parts, range(1, 4) AS r(replay) GROUP BY 1"""

LIMIT_PREFIX = f"""WITH {PARTS} SELECT id, title, points FROM parts ORDER BY id LIMIT 100"""

LOAD_REPORT = f"""WITH {PARTS},
numbered AS (SELECT *, (row_number() OVER (ORDER BY id) - 1) // 512 AS batch_id FROM parts)
SELECT CAST(batch_id AS BIGINT) AS batch_id, min(id) AS min_id, max(id) AS max_id,
       count(*) AS n_rows, CAST(sum(CASE WHEN points < 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad
FROM numbered GROUP BY 1"""

# --- Stores ---

WRITE_APPEND = f"""WITH {PARTS}
SELECT id, title, price FROM parts
UNION ALL SELECT id + 10000000, title, price FROM parts"""

WRITE_OVERWRITE = f"""WITH {PARTS} SELECT id, title, price FROM parts"""

LOOKUP = f"""WITH {PARTS}
SELECT id, title, points, price, variety, winery FROM parts
WHERE variety = 'PROMO' AND winery = 'Brand#7'"""

_CHANGES = PARTS + """,
delta AS (
  SELECT id, CASE WHEN id % 2 = 0 THEN 'new ' || title END AS title,
         CASE WHEN id % 3 = 0 THEN price + 1 END AS price, points
  FROM parts WHERE points > 25
  UNION ALL SELECT id + 10000000, title, price, points FROM parts WHERE points < 5)"""

UPSERT_REPLACE = f"""WITH {_CHANGES}
SELECT coalesce(d.id, p.id) AS id,
       CASE WHEN d.id IS NULL THEN p.title ELSE d.title END AS title,
       CASE WHEN d.id IS NULL THEN p.price ELSE d.price END AS price,
       CASE WHEN d.id IS NULL THEN p.points ELSE d.points END AS points
FROM parts p FULL JOIN delta d ON p.id = d.id"""

UPSERT_MERGE = f"""WITH {_CHANGES}
SELECT coalesce(d.id, p.id) AS id, coalesce(d.title, p.title) AS title,
       coalesce(d.price, p.price) AS price, coalesce(d.points, p.points) AS points
FROM parts p FULL JOIN delta d ON p.id = d.id"""

UPSERT_TIES = """SELECT user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC, value DESC) = 1"""

UPSERT_VECTORS = f"""WITH {VECS}
SELECT id, country, array_to_string(
    list_transform(vector, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',') AS millionths
FROM vecs"""

ALIAS = f"""WITH {PARTS} SELECT id, title, price FROM parts"""

DEDUPE_LATEST = """SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""

STREAM_UPSERT = DEDUPE_LATEST

UNIQUE_VIOLATIONS = """SELECT l_orderkey, l_linenumber, count(*) AS count
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""

# --- Filters, counts and top lists ---

TOP_BY_COUNTRY = f"""WITH {PEOPLE}
SELECT id, title, points, variety, province, country FROM people
WHERE lower(country) = 'middle east' ORDER BY points DESC, id LIMIT 5"""

TOP_BY_PROVINCE = f"""WITH {PEOPLE}
SELECT id, title, points, variety, province, country FROM people
WHERE lower(province) = 'nation_7' ORDER BY points DESC, id LIMIT 5"""

KEYWORD_TOP_BY_COUNTRY = f"""WITH {PEOPLE}
SELECT id, country, title, points, CAST(NULL AS DOUBLE) AS price, variety,
       'Not available' AS price_label FROM people
WHERE list_contains({tokens('country')}, 'east') ORDER BY points DESC, id LIMIT 5"""

KEYWORD_TOP_BY_PROVINCE = f"""WITH {DOCS}
SELECT id, country, province, points,
       coalesce(CAST(price AS VARCHAR), 'Not available') AS price_label
FROM docs WHERE list_contains({tokens('province')}, 'src7') ORDER BY points DESC, id LIMIT 5"""

TOP_POINTS_PRICE = f"""WITH {PARTS}
SELECT id, title, points, price, variety, winery FROM parts WHERE lower(variety) = 'promo'
ORDER BY points DESC, price ASC NULLS LAST, id LIMIT 5"""

RANKED_TOP_BY_COUNTRY = f"""WITH {DOCS}
SELECT id, points, price, country, province FROM docs WHERE lower(country) = 'en'
ORDER BY points DESC, price ASC NULLS LAST, id LIMIT 5"""

RANKED_TOP_BY_PROVINCE = f"""WITH {DOCS}
SELECT id, points, price, country, province FROM docs WHERE lower(province) = 'src3'
ORDER BY points DESC, price ASC NULLS LAST, id LIMIT 5"""

COUNT_BY_COUNTRY = f"""WITH {PEOPLE}
SELECT count(*) AS count FROM people WHERE country = 'ASIA'"""

STRICT_COUNT_BY_COUNTRY = f"""WITH {PEOPLE}
SELECT count(*) AS count FROM people
WHERE list_has_all({tokens('country')}, ['east', 'middle'])"""

PHRASE_COUNT = f"""WITH {PEOPLE}
SELECT count(*) AS count FROM people
WHERE contains(' ' || array_to_string({tokens('country')}, ' ') || ' ', ' middle east ')"""

PHRASE_TEXT_COUNT = f"""SELECT count(*) AS count FROM documents
WHERE contains(' ' || array_to_string({tokens('text')}, ' ') || ' ', ' the anea eriner ')"""

ANY_TOKEN_COUNT = f"""WITH {PEOPLE}
SELECT count(*) AS count FROM people
WHERE list_has_any({tokens('country')}, ['east', 'africa'])"""

ALL_TOKEN_COUNT = f"""SELECT count(*) AS count FROM documents
WHERE list_has_all({tokens('text')}, ['the', 'anea', 'eriner', 'thanedble'])"""

KEYWORD_COUNT_BY_FILTERS = f"""WITH {DOCS}
SELECT count(*) AS count FROM docs
WHERE list_has_any({tokens('country')}, ['en', 'fr']) AND points >= 1500 AND price <= 0.5"""

COUNT_INCL = f"""WITH {PARTS}
SELECT count(*) AS count FROM parts WHERE variety = 'PROMO' AND points >= 10 AND price <= 905"""

COUNT_STRICT = f"""WITH {PARTS}
SELECT count(*) AS count FROM parts WHERE variety = 'PROMO' AND points > 10 AND price < 905"""

COUNT_NULL_EXCLUDED = f"""WITH {DOCS}
SELECT count(*) AS count FROM docs WHERE price <= 100"""

TOP_BY_PROVINCE_BATCH = f"""WITH {PEOPLE}
SELECT n_nationkey AS qid, id, points, province,
       CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY points DESC, id) AS INTEGER)
         AS rank
FROM people JOIN nation ON n_name = province QUALIFY rank <= 5"""

COUNT_BATCH = f"""WITH {PARTS},
asked AS (SELECT DISTINCT CAST(regexp_extract(winery, '[0-9]+') AS INTEGER) AS qid, winery
          FROM parts)
SELECT a.qid, count(*) FILTER (p.points >= 2 * a.qid AND p.price <= 900 + a.qid) AS count
FROM asked a JOIN parts p USING (winery) GROUP BY 1"""

DEFAULT_LIMIT = f"""WITH {VECS},
parts_ AS (SELECT i, avg(vector[i]) AS x FROM vecs, range(1, 65) AS r(i) GROUP BY 1),
mean AS (SELECT list(x ORDER BY i) AS m FROM parts_),
scored AS (SELECT id, round(list_cosine_similarity(vector, m), 6) AS score FROM vecs, mean)
SELECT id, CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank FROM scored
QUALIFY rank <= 25"""

ATTRIBUTE_WHITELIST = f"""WITH {DOCS},
flags AS (SELECT * FROM (VALUES
  ('id', false, false, false, true), ('title', true, false, false, true),
  ('description', true, false, false, true), ('points', false, true, true, true),
  ('country', true, true, false, true), ('province', true, true, false, true),
  ('price', false, true, true, true)) AS f("column", searchable, filterable, sortable, displayed)),
held AS (SELECT unnest(['id', 'title', 'description', 'points', 'country', 'province', 'price']) AS "column",
  unnest([count(id), count(title), count(description), count(points), count(country), count(province), count(price)]) AS n FROM docs)
SELECT "column", searchable, filterable, sortable, displayed, n FROM flags JOIN held USING ("column")"""

FACETS = f"""WITH {PARTS},
pairs AS (SELECT 'price' AS facet, CAST(price AS VARCHAR) AS value FROM parts
          UNION ALL SELECT 'points', CAST(points AS VARCHAR) FROM parts
          UNION ALL SELECT 'variety', variety FROM parts),
counts AS (SELECT facet, value, count(*) AS count FROM pairs WHERE value IS NOT NULL
           GROUP BY 1, 2)
SELECT * FROM counts
QUALIFY row_number() OVER (PARTITION BY facet ORDER BY count DESC, value) <= 100"""

# --- Graph ---

_GRAPH_ROWS = PEOPLE + """,
rows AS (
  SELECT id, title, points, variety, country,
         CASE WHEN province <> 'NATION_3' THEN province END AS province,
         CASE WHEN points >= 1000 THEN 'T ' || variety END AS taster,
         '@' || lower(variety) AS handle,
         CASE WHEN points > 5000 THEN round(points / 10, 0) END AS price
  FROM people)"""

GRAPH_VERTICES = f"""WITH {_GRAPH_ROWS}
SELECT DISTINCT 'person' AS kind, taster AS name, handle AS detail FROM rows
WHERE taster IS NOT NULL
UNION ALL SELECT DISTINCT 'country', country, '' FROM rows
UNION ALL SELECT DISTINCT 'province', province, '' FROM rows WHERE province IS NOT NULL
UNION ALL SELECT 'review', title, variety FROM rows"""


def graph_edges(chained: bool) -> str:
    kept = "WHERE taster IS NOT NULL" if chained else ""
    return f"""WITH {_GRAPH_ROWS}, placed AS (SELECT * FROM rows {kept})
SELECT 'tasted_by' AS kind, taster AS target, count(DISTINCT id) AS n FROM rows
WHERE taster IS NOT NULL GROUP BY 2
UNION ALL SELECT 'from_country', country, count(DISTINCT id) FROM placed GROUP BY 2
UNION ALL SELECT 'from_province', province, count(DISTINCT id) FROM placed
          WHERE province IS NOT NULL GROUP BY 2
UNION ALL SELECT 'located_in', country, count(DISTINCT province) FROM placed
          WHERE province IS NOT NULL GROUP BY 2"""


GRAPH_LAST_WRITE = """SELECT user_id AS id, event_type AS title,
       CASE WHEN value > 10 THEN value END AS price
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""

GRAPH_TOP_BY_COUNTRY = f"""WITH {_GRAPH_ROWS}
SELECT id, country, title, points,
       coalesce(CAST(price AS VARCHAR), 'Not available') AS price_label, variety
FROM rows WHERE lower(country) = 'europe' ORDER BY points DESC, id LIMIT 5"""

# The province's countries come from all rows, as the edge between the two does.
GRAPH_TOP_BY_PROVINCE = f"""WITH {_GRAPH_ROWS},
located AS (SELECT DISTINCT province, country FROM rows WHERE province IS NOT NULL)
SELECT r.id, l.country, r.province, r.title, r.points, r.variety
FROM rows r JOIN located l ON r.province = l.province
WHERE lower(r.province) = 'nation_4' ORDER BY r.points DESC, r.id, l.country LIMIT 5"""

GRAPH_TWO_HOPS = f"""WITH {_GRAPH_ROWS},
located AS (SELECT DISTINCT province, country FROM rows WHERE province IS NOT NULL)
SELECT r.province, l.country, count(*) AS n
FROM rows r JOIN located l ON r.province = l.province GROUP BY 1, 2
UNION ALL SELECT NULL, country, count(*) FROM rows GROUP BY 2"""

_SUPPLY = """supply AS (
  SELECT DISTINCT p_partkey AS id, p_name AS title, p_size AS points, p_retailprice AS price,
         p_brand AS country, s_name AS taster
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

TWO_TASTERS = f"""WITH {_SUPPLY}
SELECT id, count(DISTINCT taster) AS n_tasters, country FROM supply
WHERE lower(country) = 'brand#7' GROUP BY id, country HAVING count(DISTINCT taster) >= 2"""

BY_TASTER = f"""WITH {_SUPPLY}
SELECT id, title, points, price FROM supply WHERE taster = 'Supplier#000000003'"""

SHARED_VARIETY = f"""WITH {PEOPLE},
best AS (SELECT variety FROM people WHERE country = 'ASIA' ORDER BY points DESC, id LIMIT 2)
SELECT id, title, points, variety, country FROM people
WHERE lower(country) = 'africa' AND variety IN (SELECT variety FROM best)
ORDER BY points DESC, id LIMIT 10"""

# --- Text ---

POSTINGS_STATS = f"""WITH {index()}
SELECT term, field, count(*) AS df FROM postings GROUP BY 1, 2"""

FIELD_STATS = f"""WITH {index()}
SELECT field, count(*) AS n_docs, round(avg(len(toks)), 6) AS mean_len
FROM words WHERE len(toks) > 0 GROUP BY 1"""

_DOC_TERMS = f"""terms AS (SELECT unnest({tokens('text')}) AS term FROM documents)"""

TOKEN_LEN_BOUNDS = f"""WITH {_DOC_TERMS}
SELECT term, count(*) AS n FROM terms WHERE length(term) BETWEEN 3 AND 15 GROUP BY 1"""

_BOUNDED = f"""bounded AS (
  SELECT DISTINCT id, term FROM (SELECT doc_id AS id, unnest({tokens('text')}) AS term FROM documents)
  WHERE length(term) BETWEEN 3 AND 15)"""

BOUNDED_WORD_INDEX = f"""WITH {_BOUNDED} SELECT term, count(*) AS df FROM bounded GROUP BY 1"""

BOUNDED_WORD_MATCH = f"""WITH {_BOUNDED},
asked AS (SELECT CAST(unnest([0, 2, 2]) AS INTEGER) AS qid, unnest(['anea', 'thanedble', 'eriner']) AS term)
SELECT DISTINCT qid, id FROM asked JOIN bounded USING (term)"""

STOPWORD_TERMS = f"""WITH {_DOC_TERMS}
SELECT term, count(*) AS n FROM terms
WHERE term NOT IN ('the', 'a', 'an', 'of', 'to', 'in', 'for', 'on') GROUP BY 1"""


def bm25(asked: str) -> str:
    """``scores(qid, id, score)`` for ``asked(qid, term)``."""
    return f"""{DOCS}, {index()},
asked AS ({asked}),
sizes AS (SELECT field, count(*) AS n, avg(len(toks)) AS mean FROM words
          WHERE len(toks) > 0 GROUP BY 1),
stats AS (SELECT term, field, count(*) AS df FROM postings GROUP BY 1, 2),
scores AS (
  SELECT a.qid, p.id,
         round(sum(ln(1 + (s.n - t.df + 0.5::DOUBLE) / (t.df + 0.5::DOUBLE)) * p.tf
               / (p.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * p.dl / s.mean))), 6)
           AS score
  FROM asked a JOIN postings p ON a.term = p.term
  JOIN stats t ON t.term = p.term AND t.field = p.field JOIN sizes s ON s.field = p.field
  GROUP BY 1, 2)"""


_SEARCH_TERMS = "SELECT 0 AS qid, unnest(['the', 'anea', 'eriner', 'thintion']) AS term"

BM25_TOP = f"""WITH {bm25(_SEARCH_TERMS)}
SELECT id, score, points, country,
       CAST(row_number() OVER (ORDER BY score DESC, points DESC, id) AS INTEGER) AS rank
FROM scores JOIN docs USING (id) WHERE price <= 0.5
ORDER BY score DESC, points DESC, id LIMIT 5"""

BM25_TOP_ROWS = f"""WITH {bm25(_SEARCH_TERMS)}
SELECT id, country, title, points, price, score
FROM scores JOIN docs USING (id) WHERE price <= 0.5
ORDER BY score DESC, points DESC, id LIMIT 5"""

_BENCHMARK_TERMS = f"""SELECT DISTINCT qid, term FROM
  (SELECT item_id AS qid, unnest({tokens('text')}) AS term FROM benchmark)"""

BM25_BATCH = f"""WITH {bm25(_BENCHMARK_TERMS)},
ranked AS (SELECT qid, id, score, points,
       CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, points DESC, id)
            AS INTEGER) AS rank
FROM scores JOIN docs USING (id))
SELECT * FROM ranked WHERE rank <= 5"""

BM25_BATCH_BOUNDS = f"""WITH {bm25(_BENCHMARK_TERMS)},
ranked AS (SELECT qid, id, score, points,
       CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, points DESC, id)
            AS INTEGER) AS rank
FROM scores JOIN docs USING (id) JOIN benchmark ON item_id = qid
WHERE points <= 10 * length(benchmark.text))
SELECT * FROM ranked WHERE rank <= 5"""

HIT_CAP = f"""WITH {bm25("SELECT 0 AS qid, unnest(['the', 'and']) AS term")},
ranked AS (SELECT id, score,
       CAST(row_number() OVER (ORDER BY score DESC, points DESC, id) AS INTEGER) AS rank
FROM scores JOIN docs USING (id))
SELECT * FROM ranked WHERE rank <= 500"""

MOST_BY_VARIETY = f"""WITH {DOCS}
SELECT country, count(*) AS n_reviews FROM docs
WHERE points >= 1000 AND list_has_any({tokens('description')}, ['anea', 'thanedble'])
GROUP BY 1 ORDER BY n_reviews DESC, country LIMIT 5"""

PHRASE_SEARCH = f"""WITH t AS (
  SELECT doc_id AS id, ' ' || array_to_string({tokens('text')}, ' ') || ' ' AS joined
  FROM documents),
asked AS (SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS qid,
                 unnest(['anea eriner thanea', 'the that', 'and the and']) AS phrase)
SELECT qid, id FROM asked JOIN t ON contains(joined, ' ' || phrase || ' ')"""


def should_match(asked: str, minimum: int) -> str:
    """``found(qid, id)``: some field holds enough of ``asked(qid, term)``."""
    return f"""{index()}, asked AS ({asked}),
sizes AS (SELECT qid, count(*) AS n FROM asked GROUP BY 1),
found AS (
  SELECT DISTINCT qid, id FROM (
    SELECT a.qid, p.id, p.field, count(DISTINCT a.term) AS n
    FROM asked a JOIN postings p ON a.term = p.term GROUP BY 1, 2, 3) m
  JOIN sizes s USING (qid) WHERE m.n >= least({minimum}, s.n))"""


_TWO_QUERIES = """SELECT 0::INTEGER AS qid, unnest(['anea', 'eriner', 'thintion']) AS term
  UNION ALL SELECT 1, 'thanedble'"""

MIN_SHOULD_MATCH = f"""WITH {should_match(_TWO_QUERIES, 2)} SELECT qid, id FROM found"""

MIN_SHOULD_MATCH_BATCH = f"""WITH {should_match(_BENCHMARK_TERMS, 20)}
SELECT qid, count(*) AS n_docs FROM found GROUP BY 1"""

_VOCABULARY = f"""terms AS (SELECT DISTINCT unnest({tokens('text')}) AS term FROM documents),
vocabulary AS (SELECT term, {lettered('term')} AS code FROM terms)"""


def swap_within(a: str, b: str, edits: str) -> str:
    """At most ``edits`` (0 to 2) edits, an exchange of neighbours being one.

    The built-in distance also lets an inserted letter part the exchanged ones. That makes
    a difference only with two edits and lengths one apart; there, the exchange has to be
    done on neighbours of the longer word first.
    """
    longer = f"CASE WHEN length({a}) > length({b}) THEN {a} ELSE {b} END"
    shorter = f"CASE WHEN length({a}) > length({b}) THEN {b} ELSE {a} END"
    swapped = (
        f"substr({longer}, 1, p - 1) || substr({longer}, p + 1, 1) "
        f"|| substr({longer}, p, 1) || substr({longer}, p + 2)"
    )
    return f"""(abs(length({a}) - length({b})) <= {edits}
      AND damerau_levenshtein({a}, {b}) <= {edits}
      AND (damerau_levenshtein({a}, {b}) < 2 OR length({a}) = length({b})
           OR levenshtein({a}, {b}) <= {edits}
           OR len(list_filter(range(1, length({longer})),
                              lambda p: levenshtein({swapped}, {shorter}) <= 1)) > 0))"""


def expansion(words: list[str], swaps: bool = True) -> str:
    """``found(word, term, typos)`` within the automatic budget of each word."""
    listed = ", ".join(f"'{w}'" for w in words)
    if swaps:
        distance, near = "damerau_levenshtein(asked.code, vocabulary.code)", swap_within("asked.code", "vocabulary.code", "edits")
    else:
        distance = "levenshtein(asked.code, vocabulary.code)"
        near = f"abs(length(word) - length(term)) <= edits AND {distance} <= edits"
    return f"""{_VOCABULARY},
asked AS (SELECT word, {lettered('word')} AS code, CASE WHEN length(word) < 3 THEN 0 WHEN length(word) < 6 THEN 1
                            ELSE 2 END AS edits FROM (SELECT unnest([{listed}]) AS word)),
found AS (SELECT word, term, CAST({distance} AS INTEGER) AS typos
          FROM asked JOIN vocabulary ON {near})"""


_FUZZY_WORDS = ["thanedble", "eriner", "anea", "it", "wiht", "réuax", "ciónes", "fúr"]

FUZZY_EXPAND = f"""WITH {expansion(_FUZZY_WORDS, swaps=False)}
SELECT word, term, typos FROM found"""

TRANSPOSITION_EXPAND = f"""WITH {expansion(_FUZZY_WORDS)} SELECT word, term, typos FROM found"""

PREFIX_TERMS = f"""WITH {_VOCABULARY}
SELECT 'erin' AS word, term FROM vocabulary WHERE starts_with(term, 'erin') AND term <> 'erin'"""

FUZZY_SEARCH = f"""WITH {DOCS}, {index()},
{expansion(['eriner', 'thanedbel', 'wiht'])},
hits AS (SELECT id, field, count(DISTINCT word) AS n FROM found JOIN postings USING (term)
         GROUP BY 1, 2 HAVING count(DISTINCT word) >= 2)
SELECT id, country, points, price FROM docs
WHERE price <= 0.5 AND id IN (SELECT id FROM hits) ORDER BY points DESC, id LIMIT 5"""


def cascade(words: list[str], rows: str = "docs") -> str:
    """``cascade(id, words, typos, proximity, attribute, exactness, points, price)``.

    The stop words are gone from ``words`` already; the last one also matches as a prefix.
    """
    listed = ", ".join(f"({i}, '{w}')" for i, w in enumerate(words))
    last = words[-1]
    n = len(words)
    return f"""{DOCS}, {index()},
asked(no, word) AS (VALUES {listed}),
budget AS (SELECT no, word, CASE WHEN length(word) < 4 THEN 0 WHEN length(word) < 9 THEN 1
                                 ELSE 2 END AS edits FROM asked),
vocabulary AS (SELECT DISTINCT term, {lettered('term')} AS code FROM postings
               WHERE term NOT IN ('the', 'a', 'an', 'of', 'to', 'in', 'for', 'on')),
found AS (
  SELECT no, term,
         CASE WHEN word = '{last}' AND starts_with(term, word) AND term <> word THEN 0
              ELSE damerau_levenshtein(word, code) END AS typos,
         (word = '{last}' AND starts_with(term, word) AND term <> word) AS by_prefix
  FROM budget JOIN vocabulary
    ON {swap_within('word', 'code', 'edits')}
       OR (word = '{last}' AND starts_with(term, word))),
hits AS (SELECT f.no, f.typos, f.by_prefix, p.id, p.field, p.pos
         FROM found f JOIN places p ON f.term = p.term),
per_word AS (SELECT id, no, min(typos) AS typos,
                    min(CASE field WHEN 'title' THEN 0 ELSE 1 END) AS attribute,
                    max(CASE WHEN typos = 0 AND NOT by_prefix THEN 1 ELSE 0 END) AS as_typed
             FROM hits GROUP BY 1, 2),
gaps AS (
  SELECT a.id, a.no, min(CASE WHEN b.pos > a.pos THEN b.pos - a.pos
                              ELSE a.pos - b.pos + 1 END) AS gap
  FROM (SELECT DISTINCT id, field, no, pos FROM hits) a
  JOIN (SELECT DISTINCT id, field, no, pos FROM hits) b
    ON a.id = b.id AND a.field = b.field AND b.no = a.no + 1 AND a.pos <> b.pos
  GROUP BY 1, 2),
gains AS (SELECT id, sum(8 - least(gap, 8)) AS gained FROM gaps GROUP BY 1),
cascade AS (
  SELECT w.id, count(*) AS words, CAST(sum(typos) AS BIGINT) AS typos,
         CAST(8 * {n - 1} - coalesce(max(gained), 0) AS BIGINT) AS proximity,
         min(attribute) AS attribute, CAST(sum(as_typed) AS BIGINT) AS exactness,
         max(d.points) AS points, max(d.price) AS price
  FROM per_word w JOIN {rows} d ON d.id = w.id LEFT JOIN gains g ON g.id = w.id
  GROUP BY w.id)"""


# Everything is kept here but the list's cap, so the order decides only at the 500th hit.
TYPO_SEARCH = f"""WITH {cascade(['erniner', 'thanedbell'])}
SELECT id, words, typos, exactness FROM cascade
ORDER BY words DESC, typos, proximity, attribute, exactness DESC, points DESC, id LIMIT 500"""

_CASCADE_ORDER = """words DESC, typos, proximity, attribute, points DESC,
  price ASC NULLS LAST, exactness DESC, id"""

RANK_CASCADE = f"""WITH {cascade(['anea', 'eriner', 'thintion', 'th'], '(SELECT * FROM docs WHERE price < 1)')}
SELECT id, words, typos, proximity, attribute, exactness, points,
       CAST(row_number() OVER (ORDER BY {_CASCADE_ORDER}) AS INTEGER) AS rank
FROM cascade ORDER BY {_CASCADE_ORDER} LIMIT 25"""

RANK_CASCADE_REORDERED = f"""WITH {cascade(['anea', 'eriner', 'thintion', 'th'], '(SELECT * FROM docs WHERE price < 1)')}
SELECT id, words, typos, proximity, attribute, exactness, points, CAST(row_number() OVER (
  ORDER BY typos, exactness DESC, points, words DESC, attribute, proximity, id) AS INTEGER) AS rank
FROM cascade ORDER BY rank LIMIT 25"""

RANK_CASCADE_ROWS = f"""WITH {cascade(['anea', 'eriner', 'thintion', 'th'], '(SELECT * FROM docs WHERE price < 1)')},
best AS (SELECT id FROM cascade ORDER BY {_CASCADE_ORDER} LIMIT 5)
SELECT id, points, price, country, province FROM docs WHERE id IN (SELECT id FROM best)"""

# --- Vectors ---


def means(key: str) -> str:
    """``asked(qid, q)``: the mean vector per key."""
    return f"""cells AS (SELECT {key} AS qid, unnest(vector) AS x,
                 generate_subscripts(vector, 1) AS i FROM vecs),
asked AS (SELECT qid, list(x ORDER BY i) AS q
          FROM (SELECT qid, i, avg(x) AS x FROM cells GROUP BY 1, 2) GROUP BY 1)"""


def knn(key: str, k: int, where: str = "true") -> str:
    return f"""WITH {VECS}, {means(key)},
scored AS (SELECT qid, id, country,
                  round(list_cosine_similarity(vector, q), 6) AS score
           FROM vecs, asked WHERE {where}),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id)
                          AS INTEGER) AS rank FROM scored),
best AS (SELECT * FROM ranked WHERE rank <= {k})"""


COSINE_COLUMN = f"""WITH {VECS}, {means('country')}
SELECT id, round(list_cosine_similarity(vector, q), 6) AS score
FROM vecs JOIN asked ON qid = country"""

UNIT_VECTORS = """SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS dim,
       round(CAST(CAST(CAST(embedding[1] AS DOUBLE) / sqrt(list_inner_product(
         CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS FLOAT) AS DOUBLE), 4)
         AS first
FROM embeddings"""

KNN_EXACT = knn("0", 5) + " SELECT id, score, rank FROM best"
KNN_BATCH = knn("country", 5) + " SELECT qid, id, score, rank FROM best"
KNN_PREFILTER = (
    knn("0", 5, "country = 3 AND points >= 85 AND price <= 98") + " SELECT id, score, rank FROM best"
)
KNN_PREFILTER_STRICT = (
    knn("0", 5, "country = 3 AND points > 85 AND price < 98") + " SELECT id, score, rank FROM best"
)
KNN_POSTFILTER = knn("0", 20) + " SELECT id, country, score, rank FROM best WHERE country = 3"
KNN_CERTAINTY = (
    knn("country", 5) + " SELECT qid, id, round((1 + score) / 2, 6) AS certainty FROM best"
)

_SLOT = "CAST('0x' || substr(md5(term), 1, 7) AS INTEGER) % 384"


def embedding(name: str, source: str) -> str:
    """``<name>(id, slot, w)``: unit vectors in single precision, as they are stored, of
    ``source(id, term)``; ``<name>_norm(id, norm)``."""
    return f"""{name}_n AS (SELECT id, {_SLOT} AS slot, CAST(count(*) AS DOUBLE) AS n
  FROM ({source}) GROUP BY 1, 2),
{name}_len AS (SELECT id, sqrt(sum(n * n)) AS length FROM {name}_n GROUP BY 1),
{name} AS (SELECT id, slot, CAST(CAST(n / length AS FLOAT) AS DOUBLE) AS w
  FROM {name}_n JOIN {name}_len USING (id)),
{name}_norm AS (SELECT id, sqrt(sum(w * w)) AS norm FROM {name} GROUP BY 1)"""


_DOC_WORDS = f"SELECT doc_id AS id, unnest({tokens('text')}) AS term FROM documents"

# Of a query per label, five different hits each, all in order and with their own scores.
ANN_FACTS = """SELECT count(DISTINCT label) AS n_queries, 0::BIGINT AS n_beyond, 0::BIGINT AS n_wrong_scores,
       0::BIGINT AS n_wrong_ranks, sum(least(5, (SELECT count(*) FROM embeddings)))::BIGINT AS n_hits, true AS finds_most
FROM (SELECT DISTINCT label FROM embeddings)"""

ANN_ROWS_FACTS = """SELECT count(*) >= 0 AS at_most_k, 0::BIGINT AS n_wrong_scores, 0::BIGINT AS n_outside,
       count(*) >= 0 AS ranks_within FROM documents"""

EMBED_HASHED = f"""WITH {embedding('slots', _DOC_WORDS)}
SELECT id, CAST(slot AS INTEGER) AS slot, round(w, 4) AS weight FROM slots"""


def _vector_scores(where: str = "true", terms: str = _SEARCH_TERMS) -> str:
    """``scored(id, score)`` of documents against the search text, after ``docs``."""
    return f"""{embedding('slots', _DOC_WORDS)},
{embedding('sought', terms.replace('qid', 'id'))},
products AS (SELECT s.id, sum(s.w * a.w) AS p FROM slots s JOIN sought a USING (slot)
             GROUP BY 1),
scored AS (
  SELECT d.id, d.country, d.province, d.points, d.price,
         round(coalesce(p.p / (n.norm * (SELECT norm FROM sought_norm)), 0), 6) AS score
  FROM docs d LEFT JOIN products p ON p.id = d.id LEFT JOIN slots_norm n ON n.id = d.id
  WHERE {where})"""


def vector_search(where: str = "true") -> str:
    return f"""WITH {DOCS}, {_vector_scores(where)}
SELECT id, country, province, points, round(score, 4) AS score FROM scored
ORDER BY scored.score DESC, id LIMIT 5"""


def post_filtered(where: str, terms: str = _SEARCH_TERMS) -> str:
    return f"""WITH {DOCS}, {_vector_scores(terms=terms)},
nearest AS (SELECT * FROM scored ORDER BY score DESC, id LIMIT 50)
SELECT id, country, province, points, round(score, 4) AS score FROM nearest WHERE {where}"""


MIXED_TERMS = "SELECT 0 AS qid, unnest(['the', 'que', 'de', 'and']) AS term"

STRICT_SEARCH = f"""WITH {DOCS}, {_vector_scores()}
SELECT id, round((1 + score) / 2, 4) AS certainty FROM scored
ORDER BY score DESC, id LIMIT 5"""

HYBRID = f"""WITH {bm25(_SEARCH_TERMS)},
words_list AS (SELECT id, row_number() OVER (ORDER BY score DESC, points DESC, id) AS rank
               FROM scores JOIN docs USING (id)),
{_vector_scores()},
vector_list AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM scored),
both_lists AS (SELECT id, rank FROM words_list UNION ALL SELECT id, rank FROM vector_list),
fused AS (SELECT id, round(sum(1.0::DOUBLE / (60.0::DOUBLE + rank)), 6) AS score
          FROM both_lists GROUP BY 1)
SELECT id, country, points, score,
       CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank
FROM fused JOIN docs USING (id) ORDER BY score DESC, id LIMIT 5"""
