"""Independent SQL for the registered queries, to be run by DuckDB on the same tables.

Written from the definition of each operator, not from its Spark plan: plain windows per
class, cross products of queries and corpus, one pass per metric.
"""

from __future__ import annotations

from versemill.operators.approx import BITS, PROBES, TABLES
from versemill.plans.setup import GENRE_MAP, K, LABEL2ID, MODELS, N_LABELS, STOP_WORDS, TURN_BITS

SEED = 42
SPACES = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
NEWLINE = "chr(10)"


def strip_sql(text: str) -> str:
    return rf"regexp_replace({text}, '\A[{SPACES}]+|[{SPACES}]+\z', '', 'g')"


def _newlines(text: str) -> str:
    return f"regexp_replace({text}, chr(13) || chr(10) || '?', {NEWLINE}, 'g')"


def _squeezed(text: str) -> str:
    spaces = f"regexp_replace({text}, ' {{2,}}', ' ', 'g')"
    return f"regexp_replace({spaces}, chr(10) || '{{3,}}', chr(10) || chr(10), 'g')"


def genius_sql(text: str) -> str:
    untagged = rf"regexp_replace(lower(coalesce({text}, '')), '\[.*?\]', ' ', 'g')"
    letters = rf"regexp_replace({_newlines(untagged)}, '[^a-z0-9''{SPACES}]', ' ', 'g')"
    return strip_sql(_squeezed(letters))


def multilingual_sql(text: str) -> str:
    return strip_sql(_squeezed(_newlines(f"lower(coalesce({text}, ''))")))


GENRES = "genres(raw, label) AS (VALUES " + ", ".join(
    f"('{raw}', {LABEL2ID[genre]})" for raw, genre in sorted(GENRE_MAP.items())
) + ")"

DOCS = "docs AS (SELECT 0 AS src, doc_id AS id, text, source AS label, lang, n_chars FROM documents)"
TALKS = (
    f"talks AS (SELECT 1 AS src, conv_id * {1 << TURN_BITS} + turn AS id, text, role AS label, conv_id, turn"
    " FROM conversations)"
)

POOL = f"""{GENRES}, {DOCS}, {TALKS},
prepared AS (
  SELECT src, id, {genius_sql('text')} AS text, {strip_sql('lower(label)')} AS raw
  FROM docs WHERE lang = 'en' AND n_chars IS NOT NULL AND label IS NOT NULL
  UNION ALL
  SELECT src, id, text, {strip_sql('lower(label)')} FROM talks
  WHERE text IS NOT NULL AND label IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL
),
mapped AS (SELECT p.src, p.id, p.text, g.label FROM prepared p JOIN genres g ON g.raw = p.raw),
pool AS (
  SELECT src, id, text, label FROM mapped
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY src, id) = 1
)"""


def digest(*keys: str) -> str:
    return f"md5('{SEED}:' || " + " || ':' || ".join(keys) + ")"


def ranked_sql(name: str, base: str, keys: list[str]) -> str:
    order = ", ".join(keys)
    return (
        f"{name} AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {digest(*keys)}, {order})"
        f" AS class_rank FROM {base})"
    )


def sizes_sql(name: str, base: str) -> str:
    """Per-class train, eval and test sizes at 0.15 / 0.15, by largest remainder."""
    return f"""{name}_n AS (SELECT label, count(*) AS n FROM {base} GROUP BY label),
{name}_t AS (SELECT sum(n)::HUGEINT AS total, ceil(0.3::DOUBLE * sum(n))::HUGEINT AS held FROM {name}_n),
{name}_h AS (
  SELECT label, n, total, held, (n * held) // total AS base_h, (n * held) % total AS rest_h
  FROM {name}_n, {name}_t
),
{name}_g AS (
  SELECT *, base_h + CASE WHEN row_number() OVER (ORDER BY rest_h DESC, label)
    <= held - sum(base_h) OVER () THEN 1 ELSE 0 END AS n_held FROM {name}_h
),
{name}_e AS (
  SELECT *, ceil(0.5::DOUBLE * held)::HUGEINT AS tested,
    (n_held * ceil(0.5::DOUBLE * held)::HUGEINT) // held AS base_t,
    (n_held * ceil(0.5::DOUBLE * held)::HUGEINT) % held AS rest_t FROM {name}_g
),
{name} AS (
  SELECT label, n, (base_t + CASE WHEN row_number() OVER (ORDER BY rest_t DESC, label)
    <= tested - sum(base_t) OVER () THEN 1 ELSE 0 END)::BIGINT AS n_test, n_held::BIGINT AS n_held FROM {name}_e
)"""


def split_sql(name: str, base: str, keys: list[str]) -> str:
    return f"""{ranked_sql(name + '_r', base, keys)},
{sizes_sql(name + '_s', base)},
{name} AS (
  SELECT r.* EXCLUDE (class_rank), CASE WHEN class_rank <= s.n_test THEN 'test'
    WHEN class_rank <= s.n_held THEN 'eval' ELSE 'train' END AS split
  FROM {name}_r r JOIN {name}_s s USING (label)
)"""


PK, RK = ["src", "id"], ["src", "id", "draw"]

DRAWN = f"""{ranked_sql('ranked', 'pool', PK)},
class_n AS (SELECT label, count(*) AS n_c, min(count(*)) OVER () AS m FROM pool GROUP BY label),
draws AS (
  SELECT label, i AS draw,
    1 + ('0x' || substr({digest('label', 'i')}, 1, 15))::BIGINT % n_c AS class_rank
  FROM (SELECT label, n_c, unnest(range(1, m + 1)) AS i FROM class_n)
),
drawn AS (SELECT r.src, r.id, r.text, r.label, d.draw FROM draws d JOIN ranked r USING (label, class_rank))"""

ROWS = f"{POOL}, {DRAWN}, {split_sql('harm', 'drawn', RK)}"

WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
KEPT_WORDS = f"list_filter({WORDS}, lambda w: w NOT IN ({STOPS}))"


def terms_sql(name: str, base: str, keys: str) -> str:
    """Distinct unigrams and bigrams per row with counts (``keys, term, tf``)."""
    return f"""{name}_w AS (SELECT {keys}, {KEPT_WORDS} AS w FROM {base}),
{name}_u AS (SELECT {keys}, unnest(w) AS word, unnest(range(0, len(w))) AS word_at FROM {name}_w),
{name}_b AS (
  SELECT {keys}, word, word || ' ' || lead(word) OVER (PARTITION BY {keys} ORDER BY word_at) AS pair FROM {name}_u
),
{name} AS (
  SELECT {keys}, term, count(*) AS tf FROM (
    SELECT {keys}, word AS term FROM {name}_b UNION ALL SELECT {keys}, pair FROM {name}_b WHERE pair IS NOT NULL
  ) GROUP BY ALL
)"""


def vocab_sql(terms: str, n_rows: str) -> str:
    return f"""vocab AS (
  SELECT row_number() OVER (ORDER BY term) - 1 AS term_id, term, n_total, n_docs,
    ln((1.0::DOUBLE + {n_rows}) / (1.0::DOUBLE + n_docs)) + 1.0 AS idf
  FROM (
    SELECT term, sum(tf)::BIGINT AS n_total, count(*) AS n_docs FROM {terms}
    GROUP BY term ORDER BY n_total DESC, term LIMIT 20000
  )
)"""


TFIDF = f"""{ROWS}, {terms_sql('terms', 'harm', 'src, id, draw, split')},
train_terms AS (SELECT * FROM terms WHERE split = 'train'),
{vocab_sql('train_terms', "(SELECT count(*) FROM harm WHERE split = 'train')")},
raw_w AS (
  SELECT src, id, draw, split, term, term_id, (1 + ln(tf)) * idf AS w FROM terms JOIN vocab USING (term)
)"""

PASSES, PENALTY, PLACES = 15, 1e-4, 9


def linear_sql(name: str, rows: str, terms: str) -> str:
    """Weights of the linear model after each pass, as ``<name>_w<t>``.

    ``rows``: ``id, label, split``; ``terms``: ``id, j, x``. Each weight moves by its gradient over a
    bound of its curvature, with momentum; feature -1 is the intercept, without penalty.
    """
    out = [
        f"{name}_x AS MATERIALIZED (SELECT id, j, x FROM {terms} UNION ALL SELECT id, -1, 1.0::DOUBLE FROM {rows})",
        f"{name}_t AS MATERIALIZED (SELECT x.*, r.label FROM {name}_x x JOIN {rows} r USING (id) WHERE split = 'train')",
        f"{name}_n AS (SELECT count(*)::DOUBLE AS n FROM {rows} WHERE split = 'train')",
        f"{name}_c AS MATERIALIZED (SELECT DISTINCT label AS c FROM {name}_t)",
        f"""{name}_d AS MATERIALIZED (
  SELECT j, sum(x * reach) / (4 * any_value(n)) + any_value(p) AS d, any_value(p) AS p
  FROM (SELECT *, CASE WHEN j < 0 THEN 0 ELSE {PENALTY}::DOUBLE END AS p FROM {name}_t)
  JOIN (SELECT id, sum(x) AS reach FROM {name}_t GROUP BY id) USING (id), {name}_n GROUP BY j
)""",
        f"{name}_w0 AS MATERIALIZED (SELECT j, c, 0.0::DOUBLE AS w, 0.0::DOUBLE AS y FROM {name}_d, {name}_c)",
    ]
    for t in range(1, PASSES + 1):
        out += [
            f"{name}_m{t} AS MATERIALIZED (SELECT id, c, sum(x * y) AS m FROM {name}_t JOIN {name}_w{t - 1} USING (j) GROUP BY id, c)",
            f"""{name}_w{t} AS MATERIALIZED (
  SELECT j, c, y - (g + p * y) / d AS w, (y - (g + p * y) / d) + ({t} - 1) / ({t} + 2)::DOUBLE * ((y - (g + p * y) / d) - w) AS y
  FROM {name}_w{t - 1} JOIN {name}_d USING (j) JOIN (
    SELECT j, c, sum(x * (1 / (1 + exp(-m)) - CASE WHEN label = c THEN 1 ELSE 0 END)) / any_value(n) AS g
    FROM {name}_t JOIN {name}_m{t} USING (id), {name}_n GROUP BY j, c
  ) USING (j, c)
)""",
        ]
    return ",\n".join(out)


def linear_choice(name: str, rows: str, t: int, out: str) -> str:
    """``out``: the class that the weights after pass ``t`` choose for every row."""
    return f"""{out} AS MATERIALIZED (
  SELECT id, label AS y_true, c AS y_pred, split FROM (
    SELECT id, c, round(sum(x * w), {PLACES}) AS m FROM {name}_x JOIN {name}_w{t} USING (j) GROUP BY id, c
  ) JOIN {rows} USING (id) QUALIFY row_number() OVER (PARTITION BY id ORDER BY m DESC, c) = 1
)"""


LINEAR = f"""{TFIDF},
lin_rows AS MATERIALIZED (SELECT src || ':' || id || ':' || draw AS id, label, split FROM harm),
lin_terms AS MATERIALIZED (
  SELECT src || ':' || id || ':' || draw AS id, term_id AS j, w / sqrt(sum(w * w) OVER (PARTITION BY src, id, draw)) AS x FROM raw_w
),
{linear_sql("lin", "lin_rows", "lin_terms")}"""

VECTORS = f"""emb AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS v, label FROM embeddings
),
{split_sql('es', 'emb', ['id'])},
train AS (SELECT * FROM es WHERE split = 'train'),
class_size AS (SELECT label, count(*) AS n FROM train GROUP BY label)"""


def neighbors_sql(name: str, distance: str, where: str = "q.split = 'test'") -> str:
    return f"""{name} AS (
  SELECT q.id AS qid, q.label AS label, q.split AS split, c.id AS nid, c.label AS n_label,
    {distance}(q.v, c.v) AS distance,
    row_number() OVER (PARTITION BY q.id ORDER BY {distance}(q.v, c.v), c.id) AS rank
  FROM es q, train c WHERE {where} QUALIFY rank <= {K}
)"""


COS = neighbors_sql("nn", "list_cosine_distance")
EUC = neighbors_sql("nn", "list_distance")
EUC_HELD = neighbors_sql("nn", "list_distance", "q.split <> 'train'")


def centroid_sql(name: str, metric: str = "cosine") -> str:
    score = "10.0 * list_cosine_similarity(v, center)" if metric == "cosine" else "-list_distance(v, center)"
    return f"""{name}_c AS (
  SELECT label AS c, list(m ORDER BY pos) AS center FROM (
    SELECT label, pos, avg(x) AS m FROM (
      SELECT label, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS pos FROM train
    ) GROUP BY label, pos
  ) GROUP BY label
),
{name}_s AS (
  SELECT id, label, split, c, {score} AS s FROM es, {name}_c
  WHERE split <> 'train'
),
{name}_p AS (
  SELECT id, label, split, c, exp(s - max(s) OVER (PARTITION BY id))
    / sum(exp(s)) OVER (PARTITION BY id) * exp(max(s) OVER (PARTITION BY id)) AS p, s FROM {name}_s
),
{name} AS (
  SELECT id, label AS y_true, c AS y_pred, split FROM {name}_s
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(s, 12) DESC, c) = 1
)"""


VOTE = """vote AS (
  SELECT qid AS id, label AS y_true, n_label AS y_pred, split FROM (
    SELECT qid, label, split, n_label, count(*) AS n FROM nn GROUP BY ALL
  ) QUALIFY row_number() OVER (PARTITION BY qid ORDER BY n DESC, n_label) = 1
)"""

SWEEP = f"""classes AS (SELECT unnest(range(0, {N_LABELS})) AS c),
alphas(alpha_pos, alpha) AS (VALUES (0, 0.0::DOUBLE), (1, 0.25), (2, 0.5), (3, 0.75), (4, 1.0)),
shares AS (
  SELECT t.id, t.label, t.split, t.c, t.p AS p_model, coalesce(v.n, 0) / {K}::DOUBLE AS p_knn
  FROM teacher_p t LEFT JOIN (SELECT qid, n_label, count(*) AS n FROM nn GROUP BY ALL) v
    ON v.qid = t.id AND v.n_label = t.c
),
sweep AS (
  SELECT alpha_pos, alpha, split, id, label AS y_true, c AS y_pred FROM shares, alphas
  QUALIFY row_number() OVER (
    PARTITION BY alpha, id ORDER BY round(alpha * p_knn + (1 - alpha) * p_model, 12) DESC, c) = 1
)"""

BLEND = f"{VECTORS}, {EUC_HELD}, {centroid_sql('teacher')}, {SWEEP}"

def scores_sql(name: str, base: str, by: str) -> str:
    """Per-class F1 and recall over the union of labels, and accuracy with macro F1, per ``by``."""
    return f"""{name}_l AS (
  SELECT {by}, y_true AS label FROM {base} UNION SELECT {by}, y_pred FROM {base}
),
{name}_f AS (
  SELECT {by}, label,
    count(*) FILTER (b.y_true = label AND b.y_pred = label) AS tp,
    count(*) FILTER (b.y_true <> label AND b.y_pred = label) AS fp,
    count(*) FILTER (b.y_true = label AND b.y_pred <> label) AS fn
  FROM {name}_l JOIN {base} b USING ({by}) GROUP BY ALL
),
{name}_f1 AS (
  SELECT {by}, label, tp, fp, fn,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END AS f1,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS recall
  FROM {name}_f
),
{name} AS (
  SELECT * FROM (SELECT {by}, avg(CASE WHEN y_true = y_pred THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM {base} GROUP BY {by})
  JOIN (SELECT {by}, avg(f1) AS macro_f1 FROM {name}_f1 GROUP BY {by}) USING ({by})
  JOIN (SELECT {by}, {', '.join(f'max(f1) FILTER (label = {c}) AS f1_{c}' for c in range(N_LABELS))}
        FROM {name}_f1 GROUP BY {by}) USING ({by})
)"""


TEXT_MODEL = f"""texts AS (SELECT es.id, es.label, es.split, coalesce(d.text, '') AS text FROM es LEFT JOIN documents d ON d.doc_id = es.id),
{terms_sql('own_terms', 'texts', 'id, split')},
own_train AS (SELECT * FROM own_terms WHERE split = 'train'),
{vocab_sql('own_train', "(SELECT count(*) FROM texts JOIN documents ON doc_id = id WHERE split = 'train')")},
text_terms AS MATERIALIZED (
  SELECT id, term_id AS j, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS x
  FROM (SELECT id, term_id, (1 + ln(tf)) * idf AS w FROM own_terms JOIN vocab USING (term))
),
{linear_sql('txt', 'texts', 'text_terms')},
{linear_choice('txt', 'texts', PASSES, 'baseline')}"""

MODELS_SQL = f"""{VECTORS}, {EUC_HELD}, {VOTE}, {centroid_sql('teacher')}, {centroid_sql('student', 'euclidean')}, {TEXT_MODEL},
models AS (
  SELECT 'knn_embeddings' AS model, id, y_true, y_pred FROM vote WHERE split = 'test'
  UNION ALL SELECT 'baseline_tfidf', id, y_true, y_pred FROM baseline WHERE split = 'test'
  UNION ALL SELECT 'teacher', id, y_true, y_pred FROM teacher WHERE split = 'test'
  UNION ALL SELECT 'student', id, y_true, y_pred FROM student WHERE split = 'test'
)"""
REGISTRY = f"""{MODELS_SQL}, {SWEEP}, tested AS (SELECT * FROM sweep WHERE split = 'test'),
{scores_sql('tried', 'tested', 'alpha')},
reg AS (
  SELECT * FROM models
  UNION ALL SELECT 'hybrid', id, y_true, y_pred FROM tested
  WHERE alpha = (SELECT alpha FROM tried ORDER BY round(macro_f1, 12) DESC, alpha LIMIT 1)
)"""
METRICS = f"{REGISTRY}, {scores_sql('m', 'reg', 'model')}"
ALPHA_TEST = f"""{BLEND}, sweep_t AS (SELECT * FROM sweep WHERE split = 'test'),
{scores_sql('a', 'sweep_t', 'alpha')}"""
METRIC_NAMES = ["accuracy", "macro_f1", *[f"f1_{c}" for c in range(N_LABELS)]]


# Columns that are 32-bit in Spark (positions, ranks, class numbers).
NARROW = {
    "class_sample": "sample_rank",
    "word_tokens": "pos",
    "stop_word_filter": "pos",
    "word_ngrams": "tf",
    "tfidf_vocabulary": "term_id",
    "tfidf_vectors": "term_id",
    "hashed_text_embedding": "pos",
    "knn_cosine": "rank",
    "knn_euclidean": "rank",
    "knn_all_rows": "rank",
    "knn_approx": "rank",
    "knn_with_metadata": "rank",
    "vote_distribution": "label",
    "uniform_probabilities": "label",
    "recall_per_class": "label",
    "degradation_by_class": "loss_rank",
    "leaderboard": "position",
    "explain_errors": "rank",
    "search_report": "rank",
    "text_search": "rank",
    "materialise_embeddings": "pos",
}


def _round(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _compared(a: str, b: str) -> str:
    lines = f"SELECT model, metric, value FROM (UNPIVOT m ON {', '.join(METRIC_NAMES)} INTO NAME metric VALUE value)"
    return f"""WITH {METRICS}, l AS ({lines})
SELECT metric, round(a.value, 6) AS a, round(b.value, 6) AS b, round(b.value - a.value, 6) AS delta
FROM l a JOIN l b USING (metric) WHERE a.model = '{a}' AND b.model = '{b}'"""


def _share(split: str, t: int) -> str:
    right = "avg(CASE WHEN y_true = y_pred THEN 1.0::DOUBLE ELSE 0 END)"
    return f"(SELECT round({right}, 6) FROM after{t} WHERE split = '{split}')"


def _examples(relation: str) -> str:
    return f"""WITH {VECTORS}, {EUC}, {VOTE},
chosen AS (SELECT * FROM vote WHERE y_pred {relation} y_true),
s AS (SELECT id, y_true, y_pred FROM chosen ORDER BY {digest('id')}, id LIMIT 10)
SELECT s.id, left(d.text, 150) || '...' AS preview, y_true, y_pred,
  (SELECT count(*) FROM chosen) AS total, (SELECT count(*) FROM vote) AS out_of
FROM s LEFT JOIN documents d ON d.doc_id = s.id"""


def _pseudo(rows: str) -> str:
    return f"""sampled AS (
  SELECT id, label, text, row_number() OVER (PARTITION BY label ORDER BY {digest('id')}, id) AS sample_rank
  FROM {rows} QUALIFY sample_rank <= 50
)"""


KEYED = f"{ROWS}, keyed AS (SELECT src || ':' || id || ':' || draw AS id, label, text FROM harm WHERE split = 'train')"


def sql() -> dict[str, str]:
    position = ", ".join(f"('{m}', {i})" for i, m in enumerate(MODELS))
    f1_cols = ", ".join(f"f1_{c}" for c in range(N_LABELS))
    judged = (
        "judged AS (SELECT doc_id, text, source, lang, n_chars, quality, toxic"
        " FROM documents LEFT JOIN labels USING (doc_id))"
    )
    statements = {
        "rename_filter_language": "SELECT doc_id AS id, source AS label, text, n_chars FROM documents WHERE lang = 'en'",
        "normalise_and_map_labels": f"WITH {GENRES} SELECT doc_id AS id, label FROM documents"
        f" JOIN genres ON raw = {strip_sql('lower(source)')}",
        "clean_genius": f"SELECT doc_id AS id, {genius_sql('text')} AS text FROM documents",
        "clean_multilingual": f"SELECT doc_id AS id, {multilingual_sql('text')} AS text FROM documents",
        "drop_nulls": f"WITH {judged} SELECT doc_id AS id, quality, toxic, text FROM judged WHERE quality IS NOT NULL"
        " AND toxic IS NOT NULL AND text IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL AND n_chars IS NOT NULL",
        "stage_audit": f"""WITH {judged},
d AS (SELECT count(*) AS a, count(*) FILTER (lang = 'en') AS b,
  count(*) FILTER (lang = 'en' AND source IS NOT NULL AND n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL) AS c FROM judged),
t AS (SELECT count(*) AS a, count(*) FILTER (text IS NOT NULL AND role IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL) AS c FROM conversations)
SELECT 0 AS src, 'filter_language' AS stage, a AS n_before, b AS n_after FROM d
UNION ALL SELECT 0, 'drop_nulls', b, c FROM d
UNION ALL SELECT 1, 'filter_language', a, a FROM t UNION ALL SELECT 1, 'drop_nulls', a, c FROM t""",
        "harmonize_audit": """WITH d AS (SELECT count(*) AS a, count(*) FILTER (lang = 'en') AS b,
  count(*) FILTER (lang = 'en' AND source IS NOT NULL AND n_chars IS NOT NULL) AS c FROM documents),
t AS (SELECT count(*) AS a, count(*) FILTER (text IS NOT NULL AND role IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL) AS c FROM conversations)
SELECT 0 AS src, 'filter_language' AS stage, a AS n_before, b AS n_after FROM d
UNION ALL SELECT 0, 'drop_nulls', b, c FROM d
UNION ALL SELECT 1, 'filter_language', a, a FROM t UNION ALL SELECT 1, 'drop_nulls', a, c FROM t""",
        "custom_cleaner": "SELECT doc_id AS id, regexp_replace(lower(text), '[0-9]+', '#', 'g') AS text FROM documents",
        "union_dedup_multilingual": f"""WITH {POOL.replace("SELECT src, id, text, " + strip_sql('lower(label)') + " FROM talks", "SELECT src, id, " + multilingual_sql('text') + ", " + strip_sql('lower(label)') + " FROM talks").replace("FROM mapped\n", "FROM mapped WHERE text <> ''\n").replace("WHERE text IS NOT NULL AND label IS NOT NULL AND conv_id", "WHERE label IS NOT NULL AND conv_id")}
SELECT src, id, text, label FROM pool""",
        "union_sources": f"WITH {DOCS}, {TALKS} SELECT * FROM docs UNION ALL BY NAME SELECT * FROM talks",
        "union_dedup_first": f"WITH {POOL} SELECT src, id, text, label FROM pool",
        "class_counts": f"WITH {POOL} SELECT label, count(*) AS n FROM pool GROUP BY label",
        "min_class_count": f"WITH {POOL} SELECT min(n) AS min_n FROM (SELECT count(*) AS n FROM pool GROUP BY label)",
        "distinct_labels": f"WITH {POOL} SELECT DISTINCT label FROM pool",
        "class_rank": f"WITH {POOL}, {ranked_sql('r', 'pool', PK)} SELECT src, id, label, class_rank FROM r",
        "balance_without_replacement": f"""WITH {POOL}, {ranked_sql('r', 'pool', PK)}
SELECT src, id, label, 1::BIGINT AS draw FROM r
WHERE class_rank <= (SELECT min(n) FROM (SELECT count(*) AS n FROM pool GROUP BY label))""",
        "balance_bootstrap": f"WITH {POOL}, {DRAWN} SELECT src, id, label, draw FROM drawn",
        "stratified_split": f"WITH {POOL}, {split_sql('s', 'pool', PK)} SELECT src, id, label, split FROM s",
        "split_sizes": f"""WITH {POOL}, {sizes_sql('s', 'pool')}
SELECT label, n, n - n_held AS n_train, n_held - n_test AS n_eval, n_test FROM s""",
        "sample_n": f"WITH {POOL} SELECT src, id, label FROM pool ORDER BY {digest(*PK)}, src, id LIMIT 10",
        "shuffle_rows": f"WITH {POOL} SELECT src, id, label FROM pool ORDER BY {digest(*PK)}, src, id",
        "class_sample": f"""WITH {POOL} SELECT src, id, label,
  row_number() OVER (PARTITION BY label ORDER BY {digest(*PK)}, src, id) AS sample_rank
FROM pool QUALIFY sample_rank <= 50""",
        "harmonize": f"WITH {ROWS} SELECT src, id, draw, label, split, text FROM harm",
        "write_read_splits": f"WITH {ROWS} SELECT src, id, draw, label, split, text FROM harm",
        "word_tokens": f"""SELECT id, pos, token FROM (
  SELECT doc_id AS id, unnest({WORDS}) AS token, unnest(range(0, len({WORDS}))) AS pos FROM documents)""",
        "stop_word_filter": f"""SELECT id, pos, token FROM (
  SELECT doc_id AS id, unnest({KEPT_WORDS}) AS token, unnest(range(0, len({KEPT_WORDS}))) AS pos FROM documents)""",
        "word_ngrams": f"WITH {DOCS}, {terms_sql('terms', 'docs', 'id')} SELECT id, term, tf FROM terms",
        "tfidf_vocabulary": f"WITH {TFIDF} SELECT term_id, term, n_total, n_docs, round(idf, 6) AS idf FROM vocab",
        "tfidf_vectors": f"""WITH {TFIDF} SELECT src, id, draw, term_id,
  round(w / sqrt(sum(w * w) OVER (PARTITION BY src, id, draw)), 6) AS weight FROM raw_w""",
        "encode_fixed_length": f"""WITH {ROWS},
w AS (SELECT src, id, draw, split, {WORDS} AS ws FROM harm),
ids AS (
  SELECT term, row_number() OVER (ORDER BY n DESC, term) + 1 AS token_id FROM (
    SELECT term, count(*) AS n FROM (SELECT unnest(ws) AS term FROM w WHERE split = 'train')
    GROUP BY term)
),
placed AS (
  SELECT src, id, draw, pos, coalesce(token_id, 1) AS token_id FROM (
    SELECT src, id, draw, unnest(ws[1:128]) AS term, unnest(range(0, len(ws[1:128]))) AS pos FROM w
  ) LEFT JOIN ids USING (term)
),
lists AS (SELECT src, id, draw, list(token_id ORDER BY pos) AS l FROM placed GROUP BY ALL),
whole AS (SELECT src, id, draw, coalesce(l, []) AS l FROM w LEFT JOIN lists USING (src, id, draw))
SELECT src, id, draw,
  array_to_string(list_concat(l, list_transform(range(0, 128 - len(l)), lambda i: 0)), ' ') AS input_ids,
  array_to_string(list_transform(range(0, 128), lambda i: CASE WHEN i < len(l) THEN 1 ELSE 0 END), ' ') AS attention_mask
FROM whole""",
        "hashed_text_embedding": f"""WITH {TFIDF},
cells AS (
  SELECT src, id, draw, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS pos,
    sum(w * CASE WHEN substr(md5(term), 9, 1) < '8' THEN 1 ELSE -1 END) AS x FROM raw_w GROUP BY ALL
),
grid AS (SELECT src, id, draw, unnest(range(0, 64)) AS pos FROM harm),
len AS (SELECT src, id, draw, sqrt(sum(x * x)) AS l FROM cells GROUP BY ALL)
SELECT g.src, g.id, g.draw, g.pos,
  round(CASE WHEN l > 0 THEN coalesce(x, 0) / l ELSE 0 END, 6) AS value
FROM grid g LEFT JOIN cells USING (src, id, draw, pos) LEFT JOIN len USING (src, id, draw)""",
        "score_batches": f"""WITH {VECTORS}, {centroid_sql('t')}
SELECT id, c AS label, round(list_dot_product(v, center), 6) AS score FROM es, t_c""",
        "knn_cosine": f"WITH {VECTORS}, {COS} SELECT qid, rank, nid, round(distance, 6) AS distance FROM nn",
        "knn_euclidean": f"WITH {VECTORS}, {EUC} SELECT qid, rank, nid, round(distance, 6) AS distance FROM nn",
        "knn_all_rows": f"WITH {VECTORS}, {neighbors_sql('nn', 'list_cosine_distance', 'true')}"
        " SELECT qid, rank, nid, greatest(round(distance, 6), 0) AS distance FROM nn",
        "knn_approx": f"""WITH {VECTORS},
planes AS (
  SELECT t, b, list(CASE WHEN substr(md5('{SEED}:' || t || ':' || b || ':' || i), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0 END ORDER BY i) AS n
  FROM range({TABLES}) x(t), range({BITS}) y(b), range((SELECT max(len(v)) FROM es)) z(i) GROUP BY t, b
),
margins AS (SELECT id, split, t, b, list_dot_product(v, n) AS m FROM es, planes),
own AS (
  SELECT id, split, t, sum(CASE WHEN m > 0 THEN 1 << b ELSE 0 END)::BIGINT AS code, list(b ORDER BY abs(m), b) AS near
  FROM margins GROUP BY id, split, t
),
probed AS (
  SELECT id, t, xor(code, list_sum(list_transform(range({PROBES}), lambda p: CASE WHEN (f >> p) & 1 = 1 THEN 1 << near[p + 1] ELSE 0 END))::BIGINT) AS code
  FROM own, range({1 << PROBES}) x(f) WHERE split = 'test'
),
met AS (SELECT DISTINCT p.id AS qid, c.id AS nid FROM probed p JOIN own c ON c.t = p.t AND c.code = p.code AND c.split = 'train'),
near AS (
  SELECT qid, nid, list_cosine_distance(q.v, c.v) AS distance FROM met JOIN es q ON q.id = qid JOIN es c ON c.id = nid
)
SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY distance, nid) AS rank, nid, round(distance, 6) AS distance
FROM near QUALIFY rank <= {K}""",
        "knn_with_metadata": f"""WITH {VECTORS}, {COS}
SELECT qid, rank, nid, round(distance, 6) AS distance, n_label, text AS n_text FROM nn LEFT JOIN documents ON doc_id = nid""",
        "neighbor_labels": f"""WITH {VECTORS}, {EUC}
SELECT qid, string_agg(n_label::VARCHAR, ' ' ORDER BY rank) AS labels FROM nn GROUP BY qid""",
        "majority_vote": f"WITH {VECTORS}, {EUC}, {VOTE} SELECT id, y_true, y_pred FROM vote",
        "knn_classify": f"WITH {VECTORS}, {EUC}, {VOTE} SELECT id, y_true, y_pred FROM vote",
        "vote_distribution": f"""WITH {VECTORS}, {EUC}, classes AS (SELECT unnest(range(0, {N_LABELS})) AS c)
SELECT q.qid, c AS label, round(count(n.n_label) / {K}::DOUBLE, 6) AS p
FROM (SELECT DISTINCT qid FROM nn) q CROSS JOIN classes LEFT JOIN nn n ON n.qid = q.qid AND n.n_label = c GROUP BY ALL""",
        "precision_recall_at_k": f"""WITH {VECTORS}, {COS},
h AS (SELECT qid, label, count(*) FILTER (n_label = label) AS n_hits FROM nn GROUP BY ALL)
SELECT qid, label, n_hits, coalesce(n, 0) AS n_relevant, round(n_hits / {K}::DOUBLE, 6) AS precision_at_k,
  round(CASE WHEN coalesce(n, 0) > 0 THEN n_hits / n::DOUBLE ELSE 0 END, 6) AS recall_at_k
FROM h LEFT JOIN class_size USING (label)""",
        "mean_precision_recall": f"""WITH {VECTORS}, {COS},
h AS (SELECT qid, label, count(*) FILTER (n_label = label) AS n_hits FROM nn GROUP BY ALL)
SELECT count(*) AS n_queries, round(avg(n_hits / {K}::DOUBLE), 6) AS precision_at_k,
  round(avg(coalesce(n_hits / n::DOUBLE, 0)), 6) AS recall_at_k FROM h LEFT JOIN class_size USING (label)""",
        "centroid_scores_softmax": f"""WITH {VECTORS}, {centroid_sql('t')}
SELECT id, c AS label, round(p, 6) AS p FROM t_p WHERE split = 'test'""",
        "uniform_probabilities": f"SELECT vec_id AS id, unnest(range(0, {N_LABELS})) AS label, round(1 / {N_LABELS}::DOUBLE, 6) AS p FROM embeddings",
        "hybrid_classify": f"WITH {BLEND} SELECT id, split, y_true, y_pred FROM sweep WHERE alpha = 0.5",
        "alpha_sweep": f"""WITH {BLEND}, s2 AS (SELECT alpha || '/' || split AS run, * FROM sweep), {scores_sql('a', 's2', 'run')}
SELECT DISTINCT split, alpha, {_round('accuracy', 'macro_f1')} FROM a JOIN s2 USING (run)""",
        "best_alpha": f"WITH {ALPHA_TEST} SELECT alpha, round(macro_f1, 6) AS macro_f1 FROM a"
        " ORDER BY round(a.macro_f1, 12) DESC, alpha LIMIT 1",
        "prediction_registry": f"WITH {REGISTRY} SELECT * FROM reg",
        "evaluate_metrics": f"WITH {METRICS} SELECT model, {_round(*METRIC_NAMES)} FROM m",
        "f1_per_class": f"WITH {METRICS} SELECT model, label, round(f1, 6) AS f1 FROM m_f1",
        "recall_per_class": f"""WITH {METRICS}, c AS (SELECT unnest(range(0, {N_LABELS})) AS label)
SELECT x.model, c.label, round(coalesce(f.recall, 0), 6) AS recall
FROM (SELECT DISTINCT model FROM reg) x CROSS JOIN c LEFT JOIN m_f1 f ON f.model = x.model AND f.label = c.label""",
        "recall_matrix": f"WITH {METRICS} SELECT model, "
        + ", ".join(f"round(coalesce(max(recall) FILTER (label = {c}), 0), 6) AS recall_{c}" for c in range(N_LABELS))
        + " FROM m_f1 GROUP BY model",
        "confusion_matrix": f"""WITH {METRICS}
SELECT a.model, a.label AS y_true, b.label AS y_pred, count(r.id) AS n
FROM m_l a JOIN m_l b ON a.model = b.model
LEFT JOIN reg r ON r.model = a.model AND r.y_true = a.label AND r.y_pred = b.label GROUP BY ALL""",
        "compare_models": _compared("teacher", "student"),
        "compare_neighbors_with_tfidf": _compared("baseline_tfidf", "knn_embeddings"),
        "compare_alphas_with_teacher": f"""WITH {ALPHA_TEST},
tt AS (SELECT 'teacher' AS model, * FROM teacher WHERE split = 'test'), {scores_sql('t', 'tt', 'model')},
l AS (SELECT alpha, 'accuracy' AS metric, accuracy AS a FROM a UNION ALL SELECT alpha, 'macro_f1', macro_f1 FROM a),
b AS (SELECT 'accuracy' AS metric, accuracy AS b FROM t UNION ALL SELECT 'macro_f1', macro_f1 FROM t)
SELECT alpha, metric, round(a, 6) AS a, round(b, 6) AS b, round(b - a, 6) AS delta FROM l JOIN b USING (metric)""",
        "degradation_by_class": f"""WITH {METRICS},
d AS (SELECT label, coalesce(max(f1) FILTER (model = 'teacher'), 0) AS f1_large,
  coalesce(max(f1) FILTER (model = 'student'), 0) AS f1_small
  FROM m_f1 WHERE model IN ('teacher', 'student') GROUP BY label)
SELECT label, {_round('f1_large', 'f1_small')}, round(f1_large - f1_small, 6) AS loss,
  row_number() OVER (ORDER BY round(d.f1_large - d.f1_small, 12) DESC, label) AS loss_rank FROM d""",
        "leaderboard": f"""WITH {MODELS_SQL}, {scores_sql('m', 'models', 'model')},
{SWEEP}, sweep_t AS (SELECT * FROM sweep WHERE split = 'test'),
{scores_sql('a', 'sweep_t', 'alpha')},
best AS (SELECT 'hybrid_best_alpha_' || alpha AS model, accuracy, macro_f1, {f1_cols} FROM a
  ORDER BY round(macro_f1, 12) DESC, alpha LIMIT 1),
pos(model, p) AS (VALUES {position}),
everything AS (SELECT model, accuracy, macro_f1, {f1_cols} FROM m UNION ALL SELECT * FROM best)
SELECT model, {_round(*METRIC_NAMES)},
  row_number() OVER (ORDER BY round(e.macro_f1, 12) DESC, coalesce(p, 99)) AS position
FROM everything e LEFT JOIN pos USING (model)""",
        "correct_incorrect_counts": f"""WITH {REGISTRY}
SELECT model, CASE WHEN y_true = y_pred THEN 'right' ELSE 'wrong' END AS outcome, count(*) AS n FROM reg GROUP BY ALL""",
        "correct_examples": _examples("="),
        "incorrect_examples": _examples("<>"),
        "explain_errors": f"""WITH {VECTORS}, {COS}, {centroid_sql('student', 'euclidean')},
p AS (SELECT * FROM student WHERE split = 'test'),
s AS (
  (SELECT 'right' AS outcome, id, y_true, y_pred FROM p WHERE y_true = y_pred ORDER BY {digest('id')}, id LIMIT 3)
  UNION ALL
  (SELECT 'wrong', id, y_true, y_pred FROM p WHERE y_true <> y_pred ORDER BY {digest('id')}, id LIMIT 3)
)
SELECT outcome, id, y_true, y_pred, rank, nid, round(distance, 6) AS distance, n_label,
  left(a.text, 150) || '...' AS preview, left(b.text, 100) || '...' AS n_preview
FROM s LEFT JOIN nn ON nn.qid = s.id AND outcome = 'wrong'
LEFT JOIN documents a ON a.doc_id = s.id LEFT JOIN documents b ON b.doc_id = nid""",
        "search_report": f"""WITH {VECTORS}, {neighbors_sql('nn', 'list_cosine_distance', "q.split = 'eval'")},
q AS (SELECT id FROM es WHERE split = 'eval' ORDER BY {digest('id')}, id LIMIT 1)
SELECT qid, left(a.text, 100) || '...' AS q_preview, nn.label AS q_label, rank, nid, round(distance, 6) AS distance,
  left(b.text, 100) || '...' AS preview, n_label
FROM q JOIN nn ON qid = id LEFT JOIN documents a ON a.doc_id = qid LEFT JOIN documents b ON b.doc_id = nid""",
        "text_search": f"""WITH {POOL},
named AS (SELECT src || ':' || id AS id, text, label FROM pool),
{split_sql('sp', 'named', ['id'])},
{terms_sql('terms', 'sp', 'id, split')},
train_terms AS (SELECT * FROM terms WHERE split = 'train'),
{vocab_sql('train_terms', "(SELECT count(*) FROM sp WHERE split = 'train')")},
cells AS (
  SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS pos,
    sum((1 + ln(tf)) * idf * CASE WHEN substr(md5(term), 9, 1) < '8' THEN 1 ELSE -1 END) AS x
  FROM terms JOIN vocab USING (term) GROUP BY ALL
),
unit AS (SELECT id, pos, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM cells),
dots AS (SELECT a.id AS qid, b.id AS nid, sum(a.x * b.x) AS s FROM unit a JOIN unit b USING (pos)
  JOIN sp p ON p.id = a.id AND p.split <> 'train' JOIN sp t ON t.id = b.id AND t.split = 'train' GROUP BY ALL),
nn AS (
  SELECT q.id AS qid, c.id AS nid, c.label AS n_label, c.text AS n_text, 1 - coalesce(s, 0) AS distance,
    row_number() OVER (PARTITION BY q.id ORDER BY 1 - coalesce(s, 0), c.id) AS rank
  FROM (SELECT * FROM sp WHERE split <> 'train') q CROSS JOIN (SELECT * FROM sp WHERE split = 'train') c
  LEFT JOIN dots ON dots.qid = q.id AND dots.nid = c.id QUALIFY rank <= {K}
)
SELECT qid, rank, nid, greatest(round(distance, 6), 0) AS distance, n_label, n_text FROM nn""",
        "class_pseudo_document": f"""WITH {KEYED}, {_pseudo('keyed')}
SELECT label, count(*)::INTEGER AS n_docs, string_agg(text, ' ' ORDER BY sample_rank) AS text FROM sampled GROUP BY label""",
        "extractive_class_summary": f"""WITH {KEYED}, {_pseudo('keyed')}, {terms_sql('terms', 'keyed', 'id, label')},
{vocab_sql('terms', '(SELECT count(*) FROM keyed)')},
raw_w AS (SELECT id, label, term, (1 + ln(tf)) * idf AS w FROM terms JOIN vocab USING (term)),
unit AS (SELECT id, label, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM raw_w),
class_w AS (SELECT label, term, sum(w) / (SELECT count(*) FROM keyed k WHERE k.label = unit.label) AS cw
  FROM unit GROUP BY label, term),
parts AS (
  SELECT label, sample_rank, unnest(range(0, len(l))) AS pos, trim(unnest(l)) AS text FROM (
    SELECT label, sample_rank, regexp_extract_all(text, '[^.!?' || chr(10) || ']+[.!?]*') AS l FROM sampled)
),
sents AS (SELECT * FROM parts WHERE text <> ''),
{terms_sql('st', 'sents', 'label, sample_rank, pos, text')},
scored AS (
  SELECT label, sample_rank, pos, text, round(avg(coalesce(cw, 0)), 9) AS score
  FROM st LEFT JOIN class_w USING (label, term) GROUP BY ALL
),
kept AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY label ORDER BY score DESC, sample_rank, pos) <= 5)
SELECT label, count(*)::INTEGER AS n_sentences, string_agg(text, ' ' ORDER BY sample_rank, pos) AS summary
FROM kept GROUP BY label""",
        "linear_tfidf_predictions": f"""WITH {LINEAR}, {linear_choice("lin", "lin_rows", PASSES, "chosen")}
SELECT id, y_true, y_pred FROM chosen WHERE split = 'test'""",
        "learning_curve": f"WITH {LINEAR}, "
        + ", ".join(linear_choice("lin", "lin_rows", t, f"after{t}") for t in range(1, PASSES + 1))
        + " UNION ALL ".join(
            f"""{" SELECT * FROM (" if t == 1 else ""}SELECT {t}::INTEGER AS iteration, {_share('train', t)} AS train_acc, {_share('eval', t)} AS val_acc"""
            for t in range(1, PASSES + 1)
        )
        + ")",
        "feature_bundle": f"""WITH {TFIDF},
t AS (SELECT src, id, draw, count(*) AS n FROM raw_w GROUP BY ALL)
SELECT version::INTEGER AS version, src, id, draw, split, label, coalesce(n, 0)::INTEGER AS n_terms,
  least(len({WORDS}), 128)::INTEGER AS n_words, (SELECT count(*) FROM vocab) AS n_vocabulary
FROM harm LEFT JOIN t USING (src, id, draw), (VALUES (1), (2)) v(version) WHERE version = 2 OR split <> 'eval'""",
        "split_views": f"""WITH {TFIDF},
t AS (SELECT src, id, draw, count(*) AS n FROM raw_w GROUP BY ALL)
SELECT src, id, draw, label, coalesce(n, 0)::INTEGER AS n_terms, 128 AS n_ids,
  least(len({WORDS}), 128)::INTEGER AS n_words
FROM harm LEFT JOIN t USING (src, id, draw) WHERE split = 'test'""",
        "materialise_embeddings": """SELECT id, label, pos, round(x::DOUBLE, 6) AS value FROM (
  SELECT vec_id AS id, label, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings)""",
    }
    for name, column in NARROW.items():
        statements[name] = f"SELECT * REPLACE ({column}::INTEGER AS {column}) FROM ({statements[name]})"
    return statements
