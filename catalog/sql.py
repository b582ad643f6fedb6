"""The same results as SQL for DuckDB, over views of the given tables."""

from __future__ import annotations

from catalog.inputs import LEXICON, MASKS, PRIMES
from postsift.functions.tables import CONTRACTIONS, DELETE_CLASS, ISOLATE_CLASS, MASKED_WORDS


APOSTROPHES = "'‘’"
HIDDEN = "\ue001\ue002\ue003"  # private use, which normalisation deletes before


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- normalisation ---------------------------------------------------------


def replace(x: str, old: str, new: str) -> str:
    return f"replace({x}, {quoted(old)}, {quoted(new)})"


def regex(x: str, pattern: str, new: str) -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {quoted(new)}, 'g')"


def contractions(x: str) -> str:
    for key, value in CONTRACTIONS:
        x = replace(x, f" {key} ", f" {value} ")
    return x


def delete(x: str) -> str:
    return regex(x, f"[{DELETE_CLASS}]", " ")


def isolate(x: str) -> str:
    # Apostrophes are put out of the way, as RE2 cannot take them out of a class.
    hidden = f"translate({x}, {quoted(APOSTROPHES)}, '{HIDDEN}')"
    return f"translate({regex(hidden, f'[{ISOLATE_CLASS}]', ' ' + chr(92) + '0 ')}, '{HIDDEN}', {quoted(APOSTROPHES)})"


def quotes(x: str) -> str:
    led = f"regexp_replace({x}, {quoted(chr(94) + '[' + chr(39) + chr(34) + ']')}, '')"
    return f"regexp_replace({led}, {quoted('(?s).?[' + chr(39) + chr(34) + ']$')}, '')"


def spaces(x: str) -> str:
    return regex(x, " +", " ")


def normalized(x: str) -> str:
    return replace(quotes(spaces(isolate(delete(contractions(f"lower({x})"))))), "\\", " ")


def demasked(x: str, masks=MASKS) -> str:
    for masked, word in masks:
        x = replace(x, masked, word)
    return x


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '\\s+'), lambda t: length(t) >= 2)"


NORM = f"norm AS (SELECT doc_id, lang, text, {normalized('text')} AS data FROM documents)"
TOKENS = f"{NORM}, tok AS (SELECT doc_id, lang, text, data, {words('data')} AS tokens FROM norm)"
WORDS = f"{TOKENS}, word AS (SELECT doc_id, unnest(tokens) AS token FROM tok)"
TASK_LABEL = {"hatespeech": "toxic", "selfharm": "CASE WHEN doc_id % 3 = 0 THEN 1 - quality ELSE toxic END", "spam": "1 - quality"}


def nb(task: str) -> str:
    """Weights and prior of a task, as ``<task>_w`` and ``<task>_p``."""
    label = TASK_LABEL[task]
    return f"""{task}_l AS (SELECT doc_id, {label} AS label FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)),
    {task}_c AS (SELECT token, count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) AS n0
        FROM word JOIN {task}_l USING (doc_id) GROUP BY token),
    {task}_t AS (SELECT sum(n1) AS t1, sum(n0) AS t0, count(*) AS v FROM {task}_c),
    {task}_w AS (SELECT token, ln((n1 + 1)::DOUBLE / (t1 + v)) - ln((n0 + 1)::DOUBLE / (t0 + v)) AS weight
        FROM {task}_c, {task}_t),
    {task}_p AS (SELECT ln((count(*) FILTER (label = 1))::DOUBLE / count(*) FILTER (label = 0)) AS prior FROM {task}_l)"""


def nb_scored(task: str, divide: bool = False) -> str:
    by = "greatest(len(tokens), 1)" if divide else "1"
    return f"""{nb(task)},
    {task}_s AS (SELECT doc_id, sum(weight) AS s FROM word JOIN {task}_w USING (token) GROUP BY doc_id),
    {task}_o AS (SELECT doc_id, (coalesce(s, 0) + (SELECT prior FROM {task}_p)) / {by} AS log_odds
        FROM tok LEFT JOIN {task}_s USING (doc_id)),
    {task}_r AS (SELECT doc_id, log_odds, (log_odds > 0)::INTEGER AS pred,
        1 / (1 + exp(-abs(log_odds))) AS prob FROM {task}_o)"""


def with_words(*parts: str) -> str:
    return "WITH " + ", ".join((WORDS, *parts)) + "\n"


HATE = with_words(nb_scored("hatespeech"))

SENTIMENT = f"""sent_w(token, weight) AS (VALUES {", ".join(f"({quoted(w)}, {v}::DOUBLE)" for w, v in LEXICON.items())}),
    sent AS (SELECT doc_id, (sum(weight) < 0)::INTEGER AS sp, 1 / (1 + exp(-abs(sum(weight)))) AS sq
        FROM word JOIN sent_w USING (token) GROUP BY doc_id)"""

# --- stand-in results ------------------------------------------------------


def _stand_in() -> str:
    cols = []
    for task, prime in PRIMES.items():
        p = f"((doc_id * {prime} % 1000)::DOUBLE / 1000)"
        pred, prob = {
            "selfharm": ("prediction", "probability"),
            "sentiment": ("sentiment_prediction", "sentiment_probability"),
        }.get(task, (f"{task}_pred", f"{task}_prob"))
        cols += [f"({p} >= 0.5)::INTEGER AS {pred}", f"greatest({p}, 1 - {p}) AS {prob}"]
    return f"base AS (SELECT doc_id, {', '.join(cols)} FROM documents)"


ENSEMBLE = """harm AS (SELECT *, prediction & sentiment_prediction AS selfharm_pred,
    CASE WHEN prediction & sentiment_prediction = 1 THEN (probability + sentiment_probability) / 2
         ELSE probability END AS selfharm_prob FROM base)"""


def arbitration(spam: str = "spam_pred = 1") -> str:
    return f"""arb AS (SELECT * EXCLUDE (prediction, probability),
    CASE WHEN {spam} THEN 'spam'
         WHEN selfharm_pred = 1 AND hatespeech_pred = 1 THEN
              CASE WHEN selfharm_prob > hatespeech_prob THEN 'selfharm' ELSE 'hatespeech' END
         WHEN hatespeech_pred = 1 THEN 'hatespeech' WHEN selfharm_pred = 1 THEN 'selfharm' ELSE '0' END AS prediction,
    CASE WHEN {spam} THEN spam_prob
         WHEN selfharm_pred = 1 AND hatespeech_pred = 1 THEN greatest(selfharm_prob, hatespeech_prob)
         WHEN hatespeech_pred = 1 THEN hatespeech_prob WHEN selfharm_pred = 1 THEN selfharm_prob
         ELSE probability END AS probability FROM harm)"""


def floored(floor: float = 0.51) -> str:
    return f"""fused AS (SELECT * REPLACE (coalesce(probability, 1.0) AS probability,
    CASE WHEN prediction <> '0' AND coalesce(probability, 1.0) < {floor} THEN '0' ELSE prediction END AS prediction) FROM arb)"""


BASE = f"WITH {_stand_in()}\n"
HARM = f"WITH {_stand_in()}, {ENSEMBLE}\n"
ARB = f"WITH {_stand_in()}, {ENSEMBLE}, {arbitration()}\n"
FUSED = f"WITH {_stand_in()}, {ENSEMBLE}, {arbitration()}, {floored()}\n"

# --- sampling --------------------------------------------------------------


def _ranked(label: str, seed: int = 7) -> str:
    return f"""lab AS (SELECT doc_id, {label} AS label FROM labels),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('{seed}:' || doc_id), doc_id) AS r FROM lab),
    n AS (SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1 FROM lab),
    q AS (SELECT CASE WHEN n0 > 2 * n1 THEN n1 * 6 // 5 ELSE n0 END AS q0,
                 CASE WHEN n1 > 2 * n0 THEN n0 * 6 // 5 ELSE n1 END AS q1 FROM n)"""


def _train(source: str, c0: str, c1: str, p: float) -> str:
    """Rows per class for training: floors, then the largest remainder."""
    return f"""f AS (SELECT floor({p} * ({c0} + {c1}))::BIGINT AS t, {c0} AS c0, {c1} AS c1, {c0} + {c1} AS c FROM {source}),
    g AS (SELECT *, t * c0 // c AS f0, t * c1 // c AS f1, t * c0 % c AS r0, t * c1 % c AS r1 FROM f),
    h AS (SELECT f0 + CASE WHEN t - f0 - f1 > 0 AND r0 >= r1 THEN 1 ELSE 0 END AS k0,
                 f1 + CASE WHEN t - f0 - f1 > 0 AND r0 < r1 THEN 1 ELSE 0 END AS k1 FROM g)"""


def _split(label: str, p: float) -> str:
    return f"""WITH {_ranked(label)}, {_train("q", "q0", "q1", p)}
    SELECT doc_id, label, CASE WHEN r <= CASE label WHEN 0 THEN k0 ELSE k1 END THEN 'train' ELSE 'test' END AS split
    FROM ranked, h WHERE label IN (0, 1)"""


SURPLUS = _split("toxic", 0.8)

NB_WEIGHTS = "SELECT token, round(weight, 4) AS weight, round(prior, 4) AS prior FROM {0}_w, {0}_p"
NB_RESULT = "SELECT doc_id, round(log_odds, 4) AS log_odds, pred AS prediction, round(prob, 4) AS probability FROM {0}_r"


def _doc(expr: str) -> str:
    return f"SELECT doc_id, {expr} AS data FROM documents"


def _made_contractions() -> str:
    x = "text"
    for word, short in (("the", "don't"), ("and", "im"), ("le", "i'm"), ("der", "won't"), ("el", "y'all")):
        x = replace(x, f" {word} ", f" {short} ")
        x = replace(x, f" {short} ", f" {short} {short} ")
    return contractions(x)


def _named_sets() -> str:
    parts = []
    for task, label in TASK_LABEL.items():
        for name in ("train", "test"):
            parts.append(
                f"""SELECT doc_id, text AS data, label, '{task}' AS task, '{name}_set' AS set
                FROM ({_split(label, 0.8)}) JOIN documents USING (doc_id) WHERE split = '{name}'"""
            )
    return " UNION ALL ".join(parts)


MODERATED = f"""{with_words(nb_scored("spam"), nb_scored("hatespeech"), nb_scored("selfharm"), SENTIMENT)}, base AS (
    SELECT doc_id, data, s.pred AS spam_pred, s.prob AS spam_prob, h.pred AS hatespeech_pred, h.prob AS hatespeech_prob,
        d.pred AS prediction, d.prob AS probability, coalesce(sp, 1) AS sentiment_prediction,
        coalesce(sq, d.prob) AS sentiment_probability
    FROM tok JOIN spam_r s USING (doc_id) JOIN hatespeech_r h USING (doc_id) JOIN selfharm_r d USING (doc_id)
        LEFT JOIN sent USING (doc_id) WHERE length(data) >= 2),
    {ENSEMBLE}, {arbitration()}, {floored()}
    SELECT doc_id, data, spam_pred, round(spam_prob, 4) AS spam_prob, hatespeech_pred,
        round(hatespeech_prob, 4) AS hatespeech_prob, prediction, round(probability, 4) AS probability,
        sentiment_prediction, round(sentiment_probability, 4) AS sentiment_probability,
        selfharm_pred, round(selfharm_prob, 4) AS selfharm_prob FROM fused"""

# Weights of words from the seeds of known sentiment.
LEARNED = f"""{SENTIMENT.split("sent AS")[0]}
    side AS (SELECT doc_id, sum(weight) > 0 AS up FROM word JOIN sent_w USING (token) GROUP BY doc_id HAVING sum(weight) <> 0),
    sides AS (SELECT count(*) FILTER (up) AS u, count(*) FILTER (NOT up) AS d FROM side),
    near AS (SELECT token, count(*) FILTER (up) AS u, count(*) FILTER (NOT up) AS d
        FROM (SELECT DISTINCT doc_id, token FROM word) JOIN side USING (doc_id) GROUP BY token),
    learned AS (SELECT token, ln((n.u + 1)::DOUBLE / (n.d + 1)) - ln((s.u + 1)::DOUBLE / (s.d + 1)) AS weight, n.u + n.d AS n
        FROM near n, sides s WHERE n.u + n.d >= 5)"""

# The CRC-32 of a token's bytes, bit by bit (reflected polynomial EDB88320).
CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(range(0, strlen(token)),
        lambda i: ('0x' || substr(hex(encode(token)), 2 * i + 1, 2))::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

ONE_STEP = f"""WITH {WORDS},
    lab AS (SELECT doc_id, toxic AS y FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)),
    placed AS (SELECT token, {CRC32} % 4096 AS place FROM (SELECT DISTINCT token FROM word)),
    occ AS (SELECT doc_id, place, count(*) AS tf FROM word JOIN placed USING (token) GROUP BY ALL),
    seen AS (SELECT place, count(*) AS n FROM occ JOIN lab USING (doc_id) GROUP BY place),
    valued AS (SELECT doc_id, place, tf, ln(((SELECT count(*) FROM lab) + 1)::DOUBLE / (coalesce(n, 0) + 1)) AS idf FROM occ LEFT JOIN seen USING (place)),
    scaled AS (SELECT doc_id, place, tf * idf / sqrt(sum(tf * idf * idf) OVER (PARTITION BY doc_id)) AS x FROM valued),
    slope AS (SELECT place, sum((0.5 - y) * x) / (SELECT count(*) FROM lab) AS g FROM scaled JOIN lab USING (doc_id) GROUP BY place),
    base AS (SELECT avg(0.5 - y)::DOUBLE AS g FROM lab),
    size AS (SELECT sqrt(sum(s.g * s.g) + any_value(b.g) * any_value(b.g)) AS r FROM slope s, base b),
    odds AS (SELECT doc_id, (coalesce(z, 0) - (SELECT g FROM base)) / (SELECT r FROM size) AS z FROM tok
        LEFT JOIN (SELECT doc_id, -sum(x * g) AS z FROM scaled JOIN slope USING (place) GROUP BY doc_id) USING (doc_id))
    SELECT doc_id, (z > 0)::INTEGER AS prediction, round(1 / (1 + exp(-abs(z))), 4) AS probability FROM odds"""

CHUNKED = f"""WITH {WORDS},
    lab AS (SELECT doc_id, toxic AS y FROM labels),
    dealt AS (SELECT doc_id, y, tokens, CASE WHEN ('0x' || substr(md5(array_to_string(tokens, ' ')), 1, 8))::BIGINT % 10 = 0 THEN -1
        ELSE ('0x' || substr(md5(array_to_string(tokens, ' ')), 9, 8))::BIGINT % 5 END AS chunk FROM tok JOIN lab USING (doc_id)),
    upto AS (SELECT unnest(range(5)) AS k),
    prior AS (SELECT k, ln((count(*) FILTER (y = 1))::DOUBLE / count(*) FILTER (y = 0)) AS p FROM dealt JOIN upto ON chunk BETWEEN 0 AND k GROUP BY k),
    counts AS (SELECT k, token, count(*) FILTER (y = 1) AS n1, count(*) FILTER (y = 0) AS n0
        FROM (SELECT y, chunk, unnest(tokens) AS token FROM dealt) JOIN upto ON chunk BETWEEN 0 AND k GROUP BY ALL),
    totals AS (SELECT k, sum(n1) AS t1, sum(n0) AS t0, count(*) AS v FROM counts GROUP BY k),
    weights AS (SELECT k, token, ln((n1 + 1)::DOUBLE / (t1 + v)) - ln((n0 + 1)::DOUBLE / (t0 + v)) AS weight FROM counts JOIN totals USING (k)),
    sums AS (SELECT k, doc_id, sum(weight) AS s FROM (SELECT doc_id, unnest(tokens) AS token FROM dealt WHERE chunk = -1) JOIN weights USING (token) GROUP BY ALL),
    odds AS (SELECT k, CASE WHEN y = 1 THEN -(coalesce(s, 0) + p) ELSE coalesce(s, 0) + p END AS z
        FROM (SELECT doc_id, y FROM dealt WHERE chunk = -1) CROSS JOIN prior LEFT JOIN sums USING (k, doc_id))
    SELECT k::INTEGER AS iteration, round(avg(greatest(z, 0) + ln(1 + exp(-abs(z)))), 4) AS loss FROM odds GROUP BY k"""

UNSPACED = """WITH told AS (SELECT doc_id, regexp_split_to_array(translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', '的一是不了人我在有他这中大来上国个到说们为子和你地出'), '\\s+') AS w FROM documents),
    runs AS (SELECT doc_id, flatten(list_transform(w, lambda x: regexp_extract_all(x, '[\\p{Han}]+|[^\\p{Han}]+'))) AS r FROM told),
    cut AS (SELECT doc_id, flatten(list_transform(r, lambda x: CASE WHEN regexp_matches(x, '^\\p{Han}') AND length(x) > 1
        THEN list_transform(range(1, length(x)), lambda i: substr(x, i, 2)) ELSE [x] END)) AS t FROM runs)
    SELECT doc_id, array_to_string(list_filter(t, lambda x: length(x) >= 2), ' ') AS tokens FROM cut"""

DISPATCHED = HATE + "SELECT doc_id, pred AS hatespeech_pred, round(prob, 4) AS hatespeech_prob FROM hatespeech_r"

SQL = {
    # Models that SQL cannot fit: the queries return counts and conditions, and here is what these have to be.
    "logreg_fit": f"SELECT {1 << 16} AS features, {1 << 16} AS finite, true AS learns",
    "logreg_score": "SELECT count(*) AS n, count(*) AS inside, true AS mostly_right FROM documents",
    "fit_dispatch": """SELECT model, count(*) AS n, true AS mostly_right
    FROM labels JOIN documents USING (doc_id), (VALUES ('nb'), ('logreg')) m(model) GROUP BY model""",
    "score_dispatch_logreg": "SELECT count(*) AS n, count(*) AS same FROM documents",
    "loss_history": "SELECT true AS falls, true AS positive, true AS in_steps, true AS within_epochs",
    "score_dispatch": DISPATCHED,
    "model_roundtrip": DISPATCHED,
    "toxic_by_lang": HATE
    + "SELECT lang, pred AS toxic_pred, count(*) AS n, round(avg(prob), 4) AS mean_prob"
    " FROM tok JOIN hatespeech_r USING (doc_id) GROUP BY ALL",
    "read_labelled": "SELECT text AS data, toxic AS label FROM documents JOIN labels USING (doc_id)",
    "read_stories": "SELECT text AS data, 0::INTEGER AS label, doc_id::VARCHAR AS story_id,"
    " NULL::VARCHAR AS prediction, NULL::DOUBLE AS probability FROM documents",
    "read_quoted_splits": """SELECT replace(text, ' ', '"' || chr(10) || ',') || chr(10) AS data, 0::INTEGER AS label, doc_id,
        row_number() OVER (ORDER BY md5('5:' || doc_id)) - 1 AS place FROM documents""",
    "read_path": "SELECT doc_id, lang, text AS data FROM documents",
    "adhoc_texts": f"WITH {NORM} SELECT doc_id, data, NULL::VARCHAR AS prediction, NULL::DOUBLE AS probability"
    " FROM norm WHERE length(data) >= 2",
    "norm_lower": _doc("lower(text)"),
    "norm_contractions": _doc(_made_contractions()),
    # Literal expectations: what becomes of signs and of letters of several scripts.
    "norm_delete": _doc("regexp_replace(translate(text, 'aeoinst', '   я日ไ한'), '[\\x00-\\x1f\\x7f]', ' ', 'g')"),
    "norm_isolate": _doc(replace(replace(replace(regex("translate(text, 'ino', 'π日ह')", "[!-&(-/:-@\\[-`{-~]", " \\0 "), "a", " … "), "e", " ™ "), "s", " € ")),
    "norm_given_symbols": _doc(regex("translate(text, 'ab', '  ')", "[\\].^\\-]", " \\0 ")),
    "norm_spaces": _doc(spaces("translate(text, 'et', '  ')")),
    "norm_quotes": _doc(quotes("('''' || text || '\"')")),
    "norm_backslash": _doc("replace(replace(translate(text, 'e', '\\'), '\\', ' '), chr(10), ' ')"),
    "normalize_text": f"""SELECT 'd-' || doc_id AS id, {normalized("translate(text, 'kz', '''\\')")} AS data FROM documents
    UNION ALL SELECT 'c-' || conv_id || '-' || turn, {normalized("translate(text, 'kz', '''\\')")} FROM conversations""",
    "demask": _doc(demasked("replace(lower(text), 'e', '*')")),
    "demask_first": _doc(normalized(demasked("replace(lower(text), 'e', '*')"))),
    "demask_default": _doc(normalized(demasked("replace(lower(text), 'the', 'h*ll')", MASKED_WORDS))),
    "drop_short": f"""WITH a AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    b AS (SELECT doc_id, unnest(range(len(lines)))::INTEGER AS line, unnest(lines) AS x FROM a),
    c AS (SELECT doc_id, line, {normalized("x")} AS data FROM b)
    SELECT doc_id, line, data FROM c WHERE length(data) >= 2""",
    "filter_label": "SELECT doc_id, toxic AS label FROM labels WHERE toxic = 1",
    "rename_result": BASE + "SELECT doc_id, prediction AS spam_pred, round(probability, 4) AS spam_prob FROM base",
    "default_columns": "SELECT doc_id, text AS data, 1::INTEGER AS sentiment_prediction, text AS original FROM documents",
    "cast_prediction": BASE + "SELECT doc_id, prediction FROM base",
    "verdict_message": FUSED
    + "SELECT doc_id, CASE WHEN prediction = '0' THEN 'The post does not have any toxic content' ELSE"
    " prediction || ' detected with ' || printf('%.2f', round_even(probability * 100, 2)) || ' % probability' END AS message FROM fused",
    "result_view": FUSED + "SELECT doc_id, selfharm_pred, round(selfharm_prob, 4) AS selfharm_prob FROM fused",
    "result_view_fused": FUSED + "SELECT doc_id, prediction, round(probability, 4) AS probability FROM fused",
    "tokenize": f"WITH {TOKENS} SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM tok",
    "token_column": f"WITH {TOKENS} SELECT doc_id, text AS data, len(tokens) AS n_tokens FROM tok",
    "head_tail": f"""WITH {TOKENS} SELECT doc_id, text AS original, CASE WHEN len(tokens) >= 254
        THEN array_to_string(tokens[1:118], ' ') || ' ' || array_to_string(tokens[len(tokens) - 127:], ' ') ELSE text END AS data FROM tok""",
    "token_cap": f"WITH {TOKENS} SELECT doc_id, array_to_string(tokens[1:256], ' ') AS tokens, least(len(tokens), 256) AS n_tokens FROM tok",
    "show_tokens": f"WITH {TOKENS} SELECT doc_id, unnest(range(len(tokens))) AS position, unnest(tokens) AS token FROM tok",
    "sample_per_class": """WITH r AS (SELECT doc_id, toxic AS label, row_number() OVER (PARTITION BY toxic ORDER BY doc_id) AS r
        FROM labels WHERE toxic IN (0, 1)) SELECT doc_id, label FROM r WHERE r <= 40""",
    "sample_file_order": """WITH r AS (SELECT '"' || text || '",' || chr(10) || doc_id AS data, toxic AS label,
        row_number() OVER (PARTITION BY toxic ORDER BY md5('3:' || doc_id)) AS r
        FROM documents JOIN labels USING (doc_id) WHERE toxic IN (0, 1)) SELECT data, label FROM r WHERE r <= 40""",
    "shuffle": "SELECT doc_id, toxic AS label, md5('7:' || doc_id) AS shuffle_key FROM labels",
    "balance": f"""WITH {_ranked("toxic")} SELECT doc_id, label,
        CASE WHEN r <= CASE label WHEN 0 THEN q0 ELSE q1 END THEN 'keep' ELSE 'extra' END AS part
        FROM ranked, q WHERE label IN (0, 1)""",
    "stratified_split": f"""WITH {_ranked("toxic")}, {_train("n", "n0", "n1", 0.8)}
        SELECT doc_id, label, CASE WHEN r <= CASE label WHEN 0 THEN k0 ELSE k1 END THEN 'train' ELSE 'test' END AS split
        FROM ranked, h WHERE label IN (0, 1)""",
    "surplus_to_test": SURPLUS,
    "concat": """SELECT doc_id, toxic AS label FROM labels WHERE toxic = 0
        UNION ALL SELECT doc_id, toxic FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, toxic FROM labels WHERE toxic = 1""",
    "split_all_tasks": f"""SELECT *, 'hatespeech' AS task FROM ({_split("toxic", 0.7)})
        UNION ALL SELECT *, 'spam' AS task FROM ({_split("1 - quality", 0.7)})""",
    "nb_fit": with_words(nb("hatespeech")) + NB_WEIGHTS.format("hatespeech"),
    "nb_score": HATE + NB_RESULT.format("hatespeech"),
    "nb_score_per_token": with_words(nb_scored("spam", True)) + NB_RESULT.format("spam"),
    "streamed_large_model": HATE + NB_RESULT.format("hatespeech"),
    "nb_score_join": HATE + NB_RESULT.format("hatespeech"),
    "argmax_softmax": BASE
    + "SELECT doc_id, (hatespeech_prob > spam_prob)::INTEGER AS prediction,"
    " round(1 / (1 + exp(-4 * abs(hatespeech_prob - spam_prob))), 4) AS probability FROM base",
    "sentiment_lexicon": f"""{with_words(SENTIMENT, _stand_in())} SELECT doc_id, coalesce(sp, 1) AS sentiment_prediction,
        round(coalesce(sq, probability), 4) AS sentiment_probability FROM base LEFT JOIN sent USING (doc_id)""",
    "sentiment_words": with_words(LEARNED) + "SELECT token, round(weight, 4) AS weight, n FROM learned",
    "sentiment_fitted": f"""{with_words(LEARNED, _stand_in())}, sent AS (SELECT doc_id, sum(weight) AS s FROM word JOIN learned USING (token) GROUP BY doc_id)
        SELECT doc_id, coalesce((s < 0)::INTEGER, 1) AS sentiment_prediction,
        round(coalesce(1 / (1 + exp(-abs(s))), probability), 4) AS sentiment_probability FROM base LEFT JOIN sent USING (doc_id)""",
    "linear_score": ONE_STEP,
    "linear_continued": "SELECT unnest(range(5))::INTEGER AS epoch, true AS below, true AS falls",
    "loss_history_saved": CHUNKED,
    "tokenize_unspaced": UNSPACED,
    "fit_tasks_together": with_words(nb("spam"), nb("hatespeech"), nb("selfharm"))
    + " UNION ALL ".join(
        f"SELECT token, round(weight, 4) AS weight, '{t}' AS task FROM {t}_w" for t in ("spam", "hatespeech", "selfharm")
    ),
    "fit_task_saved": with_words(nb("spam")) + NB_WEIGHTS.format("spam"),
    "fit_all_tasks": with_words(nb("spam"), nb("hatespeech"), nb("selfharm"))
    + " UNION ALL ".join(
        f"SELECT token, round(weight, 4) AS weight, '{t}' AS task FROM {t}_w" for t in ("spam", "hatespeech", "selfharm")
    ),
    "score_task_selfharm": f"""{with_words(nb_scored("selfharm"), SENTIMENT)}, base AS (SELECT doc_id, pred AS prediction,
        prob AS probability, coalesce(sp, 1) AS sentiment_prediction, coalesce(sq, prob) AS sentiment_probability
        FROM selfharm_r LEFT JOIN sent USING (doc_id)), {ENSEMBLE}
        SELECT doc_id, prediction, round(probability, 4) AS probability, sentiment_prediction,
        round(sentiment_probability, 4) AS sentiment_probability, selfharm_pred, round(selfharm_prob, 4) AS selfharm_prob FROM harm""",
    "score_isolated": """WITH a AS (SELECT doc_id, contains(text, 'hahaha') AS bad, length(text) / 1000.0::DOUBLE - 2 AS d FROM documents)
        SELECT doc_id, CASE WHEN bad THEN 0 ELSE (d > 0)::INTEGER END AS prediction,
        CASE WHEN bad THEN 0.0::DOUBLE ELSE round(1 / (1 + exp(-abs(d))), 4) END AS probability,
        CASE WHEN bad THEN 'ValueError: no laughing' END AS score_error FROM a""",
    "selfharm_ensemble": HARM
    + "SELECT doc_id, prediction, round(probability, 4) AS probability, selfharm_pred, round(selfharm_prob, 4) AS selfharm_prob FROM harm",
    "arbitrate": ARB + "SELECT doc_id, prediction, round(probability, 4) AS probability FROM arb",
    "arbitrate_spam_floor": f"WITH {_stand_in()}, {ENSEMBLE}, {arbitration('spam_pred = 1 AND spam_prob > 0.55')}\n"
    "SELECT doc_id, prediction, round(probability, 4) AS probability FROM arb",
    "default_probability": BASE
    + "SELECT doc_id, round(coalesce(CASE WHEN prediction = 1 THEN probability END, 1.0), 4) AS probability FROM base",
    "confidence_floor": ARB
    + "SELECT doc_id, CASE WHEN prediction <> '0' AND probability < 0.6 THEN '0' ELSE prediction END AS prediction,"
    " round(probability, 4) AS probability FROM arb",
    "moderated": MODERATED,
    "streamed_verdicts": MODERATED,
    "logreg_roundtrip": "SELECT count(*) AS n, count(*) AS same, count(*) AS inside FROM documents",
    "accuracy": HATE + "SELECT round(avg((label = pred)::DOUBLE), 4) AS accuracy FROM hatespeech_l JOIN hatespeech_r USING (doc_id)",
    "confusion": HATE
    + """SELECT l::INTEGER AS label, count(*) FILTER (label = l AND pred = 0) AS pred_0, count(*) FILTER (label = l AND pred = 1) AS pred_1
    FROM hatespeech_l JOIN hatespeech_r USING (doc_id), (VALUES (0), (1)) v(l) GROUP BY l""",
    "evaluation_report": f"""{with_words(nb_scored("selfharm"), SENTIMENT)}, base AS (SELECT doc_id, label, pred,
        pred & coalesce(sp, 1) AS both_pred FROM selfharm_l JOIN selfharm_r USING (doc_id) LEFT JOIN sent USING (doc_id)),
        long AS (SELECT 'prediction' AS pred, label, pred AS p FROM base UNION ALL SELECT 'selfharm_pred', label, both_pred FROM base)
        SELECT pred, round(avg((label = p)::DOUBLE), 4) AS accuracy, count(*) FILTER (label = 0 AND p = 0) AS n_00,
        count(*) FILTER (label = 0 AND p = 1) AS n_01, count(*) FILTER (label = 1 AND p = 0) AS n_10,
        count(*) FILTER (label = 1 AND p = 1) AS n_11 FROM long GROUP BY pred""",
    "row_counts": f"""SELECT 'loaded' AS stage, count(*) AS n FROM documents
        UNION ALL SELECT split, count(*) FROM ({SURPLUS}) GROUP BY split""",
    "class_counts": "SELECT toxic AS label, count(*) AS n FROM labels GROUP BY toxic",
    "write_task": BASE
    + "SELECT doc_id, prediction AS spam_pred, round(probability, 4) AS spam_prob, text AS data FROM base JOIN documents USING (doc_id)",
    "write_fused": FUSED
    + """SELECT doc_id, spam_pred, round(spam_prob, 4) AS spam_prob, hatespeech_pred, round(hatespeech_prob, 4) AS hatespeech_prob,
    prediction, round(probability, 4) AS probability, sentiment_prediction, round(sentiment_probability, 4) AS sentiment_probability,
    selfharm_pred, round(selfharm_prob, 4) AS selfharm_prob FROM fused""",
    "write_split": SURPLUS,
    "named_sets": _named_sets(),
    "stories_to_verdicts": f"""SELECT * EXCLUDE (doc_id), 0::INTEGER AS label, doc_id::VARCHAR AS story_id FROM ({MODERATED})""",
}
