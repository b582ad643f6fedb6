"""One query per operator, over the given tables."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.inputs import (
    LEXICON,
    MASKS,
    SCHEMAS,
    labelled,
    labelled_tokens,
    posts,
    rounded,
    spam_labels,
    stand_in,
    table,
    toxic_labels,
    with_stand_in,
)
from postsift.functions import scores as S
from postsift.functions import text as T
from postsift.operators import evaluate as A
from postsift.operators import fusion as E
from postsift.operators import rows as P
from postsift.operators import sampling as R
from postsift.operators.linear import LinearConfig, fit_linear, score_linear
from postsift.operators.logreg import LogRegConfig, fit_logreg, score_logreg
from postsift.operators.naive_bayes import fit_nb, fit_nb_chunks, fit_nb_tasks, score_nb
from postsift.operators.ranking import seeded_key
from postsift.operators.scorers import fit_lexicon, score_arrow, score_sentiment
from postsift.plans.moderate import moderate, score_task
from postsift.plans.train import fit_all, fit_all_tasks as fit_together, fit_task
from postsift.plans.workspace import Settings, Workspace
from postsift.sources import posts as IO
from postsift.sources.durable import durable, fresh_path
from postsift.sources.models import load_model, save_model
from postsift.streaming.posts import stream_posts, write_batches, write_stream

# The scorer below goes to executors that have no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- flagship --------------------------------------------------------------


@query
def toxic_by_lang(spark, sf_dir):
    """Which documents are toxic, and how many per language?"""
    model = fit_nb(labelled_tokens(spark, sf_dir), "hatespeech")
    scored = score_nb(P.with_tokens(posts(spark, sf_dir)), model)
    return scored.groupBy("lang", F.col("prediction").alias("toxic_pred")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("probability"), 4).alias("mean_prob")
    )


# --- sources ---------------------------------------------------------------


def _written_posts(spark, sf_dir, fmt, *cols):
    path = fresh_path(spark, "posts")
    df = table(spark, sf_dir, "documents").select(*cols)
    options = IO.CSV_WRITE_OPTIONS if fmt == "csv" else {}
    df.write.format(fmt).options(**options).save(path)
    return path


@query
def read_labelled(spark, sf_dir):
    path = fresh_path(spark, "task")
    rows = labelled(spark, sf_dir).select("data", F.col("hatespeech").alias("label"))
    rows.write.options(**IO.CSV_WRITE_OPTIONS).csv(path)
    return IO.read_task(spark, path)


@query
def read_stories(spark, sf_dir):
    story_id = F.col("doc_id").cast("string").alias("story_id")
    path = _written_posts(spark, sf_dir, "csv", F.col("text").alias("data"), F.lit(0).alias("label"), story_id)
    return IO.read_stories(spark, path)


@query
def read_quoted_splits(spark, sf_dir):
    """Records with newlines, quotes and commas in their fields, and their places in the files."""
    path = fresh_path(spark, "quoted")
    made = F.concat(F.replace("text", F.lit(" "), F.lit('"\n,')), F.lit("\n"))
    rows = table(spark, sf_dir, "documents").select("doc_id", made.alias("data"), F.lit(0).alias("label"))
    rows.orderBy(seeded_key(5, "doc_id")).select("data", "label", "doc_id").write.options(**IO.CSV_WRITE_OPTIONS).csv(path)
    return IO.read_posts(spark, path, "csv", "data string, label int, doc_id bigint", position="place")


@query
def read_path(spark, sf_dir):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return IO.read_posts(spark, f"{sf_dir}/documents.parquet", "parquet", schema).select("doc_id", "lang", F.col("text").alias("data"))


@query
def adhoc_texts(spark, sf_dir):
    texts = posts(spark, sf_dir).select("doc_id", "data")
    return IO.from_texts(spark, texts)


# --- normalisation ---------------------------------------------------------


def _text(spark, sf_dir, made):
    return posts(spark, sf_dir).select("doc_id", made(F.col("data")).alias("data"))


@query
def norm_lower(spark, sf_dir):
    return _text(spark, sf_dir, T.lower_case)


@query
def norm_contractions(spark, sf_dir):
    """Frequent words are first turned into contractions."""

    def made(c):
        for word, short in (("the", "don't"), ("and", "im"), ("le", "i'm"), ("der", "won't"), ("el", "y'all")):
            c = F.replace(c, F.lit(f" {word} "), F.lit(f" {short} "))
            c = F.replace(c, F.lit(f" {short} "), F.lit(f" {short} {short} "))
        return T.expand_contractions(c)

    return _text(spark, sf_dir, made)


@query
def norm_delete(spark, sf_dir):
    return _text(spark, sf_dir, lambda c: T.delete_symbols(F.translate(c, "aeoinst", "😁\u200b\ue000я日ไ한")))


@query
def norm_isolate(spark, sf_dir):
    return _text(spark, sf_dir, lambda c: T.isolate_symbols(F.translate(c, "aesino", "…™€π日ह")))


@query
def norm_given_symbols(spark, sf_dir):
    return _text(spark, sf_dir, lambda c: T.isolate_symbols(T.delete_symbols(c, "ab"), "].^-"))


@query
def norm_spaces(spark, sf_dir):
    return _text(spark, sf_dir, lambda c: T.collapse_spaces(F.translate(c, "et", "  ")))


@query
def norm_quotes(spark, sf_dir):
    return _text(spark, sf_dir, lambda c: T.strip_edge_quotes(F.concat(F.lit("'"), c, F.lit('"'))))


@query
def norm_backslash(spark, sf_dir):
    return _text(spark, sf_dir, lambda c: T.blank_backslashes(F.translate(c, "e", "\\")))


@query
def normalize_text(spark, sf_dir):
    """Both corpora; two letters become a quote and a sign to give it work."""
    docs = posts(spark, sf_dir).select(F.concat_ws("-", F.lit("d"), "doc_id").alias("id"), "data")
    talk = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("id"), F.col("text").alias("data")
    )
    both = R.concat(docs, IO.spread(talk))
    return both.select("id", T.normalize_text(F.translate("data", "kz", "'\\")).alias("data"))


@query
def demask(spark, sf_dir):
    masked = _text(spark, sf_dir, lambda c: F.replace(F.lower(c), F.lit("e"), F.lit("*")))
    return masked.select("doc_id", T.demask("data", MASKS).alias("data"))


@query
def demask_first(spark, sf_dir):
    masked = _text(spark, sf_dir, lambda c: F.replace(F.lower(c), F.lit("e"), F.lit("*")))
    return masked.select("doc_id", T.normalize_text("data", demask_first=True, masks=MASKS).alias("data"))


@query
def demask_default(spark, sf_dir):
    """The default table of masks, through the flag."""
    masked = _text(spark, sf_dir, lambda c: F.replace(F.lower(c), F.lit("the"), F.lit("h*ll")))
    return masked.select("doc_id", T.normalize_text("data", demask_first=True).alias("data"))


@query
def drop_short(spark, sf_dir):
    """Each line of a text is a post of its own."""
    lines = posts(spark, sf_dir).select("doc_id", F.posexplode(F.split("data", "\n")).alias("line", "data"))
    return P.normalize_rows(lines)


# --- projections -----------------------------------------------------------


@query
def filter_label(spark, sf_dir):
    return P.filter_label(toxic_labels(spark, sf_dir), 1)


@query
def rename_result(spark, sf_dir):
    base = stand_in(spark, sf_dir).select("doc_id", "prediction", "probability")
    return rounded(P.rename_result(base, "spam"), "spam_prob")


@query
def default_columns(spark, sf_dir):
    return P.default_columns(
        posts(spark, sf_dir).select("doc_id", "data"),
        {"sentiment_prediction": 1, "original": F.col("data")},
    )


@query
def cast_prediction(spark, sf_dir):
    base = stand_in(spark, sf_dir).select("doc_id", F.col("prediction").cast("double").alias("prediction"))
    return P.cast_prediction(base)


def _fused(spark, sf_dir):
    return E.fuse(E.selfharm_ensemble(stand_in(spark, sf_dir)))


@query
def verdict_message(spark, sf_dir):
    message = S.verdict_message("prediction", "probability").alias("message")
    return _fused(spark, sf_dir).select("doc_id", message)


@query
def result_view(spark, sf_dir):
    fused = _fused(spark, sf_dir)
    return rounded(P.result_view(fused, "selfharm", ("doc_id",)), "selfharm_prob")


@query
def result_view_fused(spark, sf_dir):
    return rounded(P.result_view(_fused(spark, sf_dir), keys=("doc_id",)), "probability")


# --- tokens ----------------------------------------------------------------


@query
def tokenize(spark, sf_dir):
    tokens = posts(spark, sf_dir).select("doc_id", T.tokenize("data").alias("tokens"))
    return tokens.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


# For each letter one of a script that puts no blanks between words.
UNSPACED_LETTERS = "的一是不了人我在有他这中大来上国个到说们为子和你地出"


@query
def tokenize_unspaced(spark, sf_dir):
    made = F.translate(F.lower("data"), "abcdefghijklmnopqrstuvwxyz", UNSPACED_LETTERS)
    return posts(spark, sf_dir).select("doc_id", F.array_join(T.tokenize(made, normalized=True), " ").alias("tokens"))


@query
def token_column(spark, sf_dir):
    rows = P.with_tokens(posts(spark, sf_dir))
    return rows.select("doc_id", "data", F.size("tokens").cast("bigint").alias("n_tokens"))


@query
def head_tail(spark, sf_dir):
    return P.head_tail(posts(spark, sf_dir).select("doc_id", "data"), 256)


@query
def token_cap(spark, sf_dir):
    rows = P.with_capped_tokens(P.with_tokens(posts(spark, sf_dir)), 256)
    return rows.select("doc_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").cast("bigint").alias("n_tokens"))


@query
def show_tokens(spark, sf_dir):
    shown = P.show_tokens(posts(spark, sf_dir), ("doc_id",))
    return shown.withColumn("position", F.col("position").cast("bigint"))


# --- sampling --------------------------------------------------------------


@query
def sample_per_class(spark, sf_dir):
    return R.sample_per_class(toxic_labels(spark, sf_dir), 40.5, "doc_id")


@query
def sample_file_order(spark, sf_dir):
    """The first rows of each class as they stand in files, whose fields hold quotes and newlines."""
    path = fresh_path(spark, "in_order")
    rows = labelled(spark, sf_dir).select(F.concat(F.lit('"'), "data", F.lit('",\n'), "doc_id").alias("data"), F.col("hatespeech").alias("label"), "doc_id")
    rows.orderBy(seeded_key(3, "doc_id")).drop("doc_id").write.options(**IO.CSV_WRITE_OPTIONS).csv(path)
    return R.sample_per_class(IO.read_task(spark, path, position="place"), 40.5, "place").drop("place")


@query
def shuffle(spark, sf_dir):
    return R.shuffle(toxic_labels(spark, sf_dir), "doc_id", 7).withColumn("shuffle_key", seeded_key(7, "doc_id"))


@query
def balance(spark, sf_dir):
    return R.balance(toxic_labels(spark, sf_dir), "doc_id", 7)


@query
def stratified_split(spark, sf_dir):
    return R.stratified_split(toxic_labels(spark, sf_dir), 0.8, "doc_id", 7)


@query
def surplus_to_test(spark, sf_dir):
    return R.split_task(toxic_labels(spark, sf_dir), 0.8, "doc_id", 7)


@query
def concat(spark, sf_dir):
    labels = toxic_labels(spark, sf_dir)
    return R.concat(P.filter_label(labels, 0), P.filter_label(labels, 1), P.filter_label(labels, 1))


@query
def split_all_tasks(spark, sf_dir):
    sets = R.split_all(
        {"hatespeech": toxic_labels(spark, sf_dir), "spam": spam_labels(spark, sf_dir)}, 0.7, "doc_id", 7
    )
    return R.concat(*[df.withColumn("task", F.lit(task)) for task, df in sets.items()])


# --- training and scoring --------------------------------------------------


@query
def nb_fit(spark, sf_dir):
    model = fit_nb(labelled_tokens(spark, sf_dir), "hatespeech")
    return rounded(model.weights.withColumn("prior", F.lit(model.prior)), "weight", "prior").drop("n")


@query
def nb_score(spark, sf_dir):
    model = fit_nb(labelled_tokens(spark, sf_dir), "hatespeech")
    scored = score_nb(P.with_tokens(posts(spark, sf_dir)), model)
    return rounded(scored.select("doc_id", "log_odds", "prediction", "probability"), "log_odds", "probability")


@query
def nb_score_per_token(spark, sf_dir):
    model = fit_nb(labelled_tokens(spark, sf_dir), "spam")
    scored = score_nb(P.with_tokens(posts(spark, sf_dir)), model, per_token=True)
    return rounded(scored.select("doc_id", "log_odds", "prediction", "probability"), "log_odds", "probability")


@query
def nb_score_join(spark, sf_dir):
    """The way for models too large to broadcast: here a thousand tokens are."""
    model = fit_nb(labelled_tokens(spark, sf_dir), "hatespeech")
    scored = score_nb(P.with_tokens(posts(spark, sf_dir)), model, broadcast_tokens=1000)
    return rounded(scored.select("doc_id", "log_odds", "prediction", "probability"), "log_odds", "probability")


@query
def argmax_softmax(spark, sf_dir):
    base = stand_in(spark, sf_dir)
    raw = F.array(F.col("spam_prob") * 4, F.col("hatespeech_prob") * 4)
    result = S.argmax_confidence(raw)
    both = base.select("doc_id", result.alias("r")).select("doc_id", "r.prediction", "r.probability")
    return rounded(both, "probability")


@query
def sentiment_lexicon(spark, sf_dir):
    rows = with_stand_in(P.with_tokens(posts(spark, sf_dir)))
    scored = score_sentiment(rows, LEXICON)
    return rounded(scored.select("doc_id", "sentiment_prediction", "sentiment_probability"), "sentiment_probability")


@query
def sentiment_fitted(spark, sf_dir):
    """Weights learned from a few words of known sentiment, as a frame, of which a hundred words are broadcast."""
    rows = with_stand_in(P.with_tokens(posts(spark, sf_dir)))
    scored = score_sentiment(rows, fit_lexicon(rows, LEXICON))
    return rounded(scored.select("doc_id", "sentiment_prediction", "sentiment_probability"), "sentiment_probability")


@query
def sentiment_words(spark, sf_dir):
    return rounded(fit_lexicon(P.with_tokens(posts(spark, sf_dir)), LEXICON), "weight")


CONFIG = LogRegConfig(epochs=10, features=1 << 16)
ONE_STEP = LinearConfig(epochs=1, features=1 << 12, reg=0.0)


@query
def linear_score(spark, sf_dir):
    """All posts by a regression that took one step down its gradient, saved and loaded."""
    folder = fresh_path(spark, "models")
    save_model(fit_linear(labelled_tokens(spark, sf_dir), ONE_STEP, "hatespeech"), folder, "hatespeech", spark)
    scored = score_linear(P.with_tokens(posts(spark, sf_dir)), load_model(folder, "hatespeech", spark))
    return rounded(scored.select("doc_id", "prediction", "probability"), "probability")


@query
def linear_continued(spark, sf_dir):
    """A saved model goes on with other rows: by epoch, is its loss below that of one that begins with them, and
    has it not risen?"""
    folder, cfg = fresh_path(spark, "models"), LinearConfig(epochs=4, features=1 << 14, reg=1e-4)
    rows = durable(labelled_tokens(spark, sf_dir), "labelled")
    first, second = rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1")
    fit_task(first, "linear", cfg, "hatespeech", folder=folder, task="hatespeech")
    warm = fit_task(second, "linear", cfg, "hatespeech", start=load_model(folder, "hatespeech", spark))
    cold = fit_task(second, "linear", cfg, "hatespeech")
    steps = [(h[1], h[2], c[2]) for h, c in zip(warm.history[cfg.epochs + 1 :], cold.history, strict=True)]
    told = [(e, w <= c, e == 0 or w <= steps[e - 1][1]) for e, w, c in steps]
    return spark.createDataFrame(told, "epoch int, below boolean, falls boolean")


@query
def logreg_fit(spark, sf_dir):
    """The size of the model, and whether it tells its own training rows better than their majority does."""
    rows = durable(labelled_tokens(spark, sf_dir), "labelled")
    model = fit_logreg(rows, CONFIG, "hatespeech")
    fitted = model.pipeline.stages[-1]
    weights = fitted.coefficients.toArray()
    hits = A.accuracy(score_logreg(rows, model), "hatespeech")
    common = rows.agg(F.greatest(F.avg("hatespeech"), 1 - F.avg("hatespeech")).alias("share"))
    return hits.join(common).select(
        F.lit(int(weights.size)).alias("features"),
        F.lit(int(np.isfinite(weights).sum())).alias("finite"),
        (F.col("accuracy") > F.col("share")).alias("learns"),
    )


@query
def logreg_score(spark, sf_dir):
    """Rows scored, results within bounds, and training rows told right."""
    model = fit_logreg(labelled_tokens(spark, sf_dir), CONFIG, "hatespeech")
    scored = score_logreg(P.with_tokens(posts(spark, sf_dir)), model)
    inside = F.col("prediction").isin(0, 1) & F.col("probability").between(0.5, 1)
    known = scored.join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    right = F.count_if(F.col("toxic") == F.col("prediction")) >= 0.9 * F.count("toxic")
    return known.agg(F.count(F.lit(1)).alias("n"), F.count_if(inside).alias("inside"), right.alias("mostly_right"))


@query
def logreg_roundtrip(spark, sf_dir):
    """A saved and loaded model scores all posts as before, and within bounds."""
    folder = fresh_path(spark, "models")
    model = fit_logreg(labelled_tokens(spark, sf_dir), CONFIG, "hatespeech")
    save_model(model, folder, "hatespeech", spark)
    rows = P.with_tokens(posts(spark, sf_dir)).select("doc_id", "tokens")
    result = F.struct("prediction", F.round("probability", 9).alias("probability"))
    before = score_logreg(rows, model).select("doc_id", "tokens", result.alias("a"))
    both = score_logreg(before, load_model(folder, "hatespeech", spark)).withColumn("b", result)
    inside = F.col("a.prediction").isin(0, 1) & F.col("a.probability").between(0.5, 1)
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("a") == F.col("b")).alias("same"),
        F.count_if(inside).alias("inside"),
    )


@query
def fit_dispatch(spark, sf_dir):
    """Both kinds of trainer by name: rows scored, and labels told right by most."""
    rows = durable(labelled_tokens(spark, sf_dir), "labelled")
    made = []
    for kind in ("nb", "logreg"):
        scored = score_task(rows, fit_task(rows, kind, CONFIG, "hatespeech"), "hatespeech")
        right = F.count_if(F.col("hatespeech") == F.col("hatespeech_pred")) >= 0.85 * F.count(F.lit(1))
        made.append(scored.agg(F.lit(kind).alias("model"), F.count(F.lit(1)).alias("n"), right.alias("mostly_right")))
    return R.concat(*made)


@query
def fit_task_saved(spark, sf_dir):
    folder = fresh_path(spark, "models")
    fit_task(labelled(spark, sf_dir), "nb", label="spam", folder=folder, task="spam")
    model = load_model(folder, "spam", spark)
    return rounded(model.weights.withColumn("prior", F.lit(model.prior)), "weight", "prior").drop("n")


@query
def fit_all_tasks(spark, sf_dir):
    rows = labelled_tokens(spark, sf_dir)
    frames = {t: rows.select("data", "tokens", F.col(t).alias("label")) for t in ("spam", "hatespeech", "selfharm")}
    models = fit_all(frames, {t: "nb" for t in frames})
    made = [m.weights.drop("n").withColumn("task", F.lit(t)) for t, m in models.items()]
    return rounded(R.concat(*made), "weight")


@query
def fit_tasks_together(spark, sf_dir):
    """Posts of all tasks in one frame, with the task in a column, counted in one pass."""
    rows = labelled_tokens(spark, sf_dir)
    tasks = F.explode(F.create_map(*[c for t in P.TASKS for c in (F.lit(t), F.col(t))])).alias("task", "label")
    models = fit_together(rows.select("tokens", tasks), {t: "nb" for t in P.TASKS})
    made = [m.weights.drop("n").withColumn("task", F.lit(t)) for t, m in models.items()]
    return rounded(R.concat(*made), "weight")


@query
def score_dispatch(spark, sf_dir):
    """Naive Bayes through the one call, row by row."""
    model = fit_nb(labelled_tokens(spark, sf_dir), "hatespeech")
    scored = score_task(posts(spark, sf_dir), model, "hatespeech")
    return rounded(scored.select("doc_id", "hatespeech_pred", "hatespeech_prob"), "hatespeech_prob")


@query
def score_dispatch_logreg(spark, sf_dir):
    """A regression through the one call gives what its own scorer gives."""
    model = fit_logreg(labelled_tokens(spark, sf_dir), CONFIG, "hatespeech")
    scored = score_task(P.with_tokens(posts(spark, sf_dir)), model, "hatespeech")
    both = score_logreg(scored, model)
    same = (F.col("hatespeech_pred") == F.col("prediction")) & (F.abs(F.col("hatespeech_prob") - F.col("probability")) < 1e-9)
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("same"))


@query
def score_task_selfharm(spark, sf_dir):
    model = fit_nb(labelled_tokens(spark, sf_dir), "selfharm")
    scored = score_task(posts(spark, sf_dir), model, "selfharm", lexicon=LEXICON)
    probs = ("probability", "sentiment_probability", "selfharm_prob")
    return rounded(scored.drop("data", "lang"), *probs)


def _length_scorer():
    """A model of the caller's that cannot do with the word `hahaha`."""

    def score(texts):
        if texts.str.contains("hahaha").any():
            raise ValueError("no laughing")
        size = texts.str.len().to_numpy(dtype=float)
        return np.stack([np.full(len(size), 2.0), size / 1000], axis=1)

    return score


@query
def score_isolated(spark, sf_dir):
    scored = score_arrow(posts(spark, sf_dir), _length_scorer)
    return rounded(scored.select("doc_id", "prediction", "probability", "score_error"), "probability")


# --- fusion ----------------------------------------------------------------


@query
def selfharm_ensemble(spark, sf_dir):
    done = E.selfharm_ensemble(stand_in(spark, sf_dir))
    return rounded(done.select("doc_id", "prediction", "probability", "selfharm_pred", "selfharm_prob"), "probability", "selfharm_prob")


@query
def arbitrate(spark, sf_dir):
    done = E.arbitrate(E.selfharm_ensemble(stand_in(spark, sf_dir)))
    return rounded(done.select("doc_id", "prediction", "probability"), "probability")


@query
def arbitrate_spam_floor(spark, sf_dir):
    done = E.arbitrate(E.selfharm_ensemble(stand_in(spark, sf_dir)), spam_min_prob=0.55)
    return rounded(done.select("doc_id", "prediction", "probability"), "probability")


@query
def default_probability(spark, sf_dir):
    some = F.when(F.col("prediction") == 1, F.col("probability"))
    done = E.default_probability(stand_in(spark, sf_dir).select("doc_id", some.alias("probability")))
    return rounded(done, "probability")


@query
def confidence_floor(spark, sf_dir):
    done = E.confidence_floor(E.arbitrate(E.selfharm_ensemble(stand_in(spark, sf_dir))), 0.6)
    return rounded(done.select("doc_id", "prediction", "probability"), "probability")


def _moderated(spark, sf_dir):
    tasks = ("spam", "hatespeech", "selfharm")
    models = fit_nb_tasks(labelled_tokens(spark, sf_dir), {t: t for t in tasks})
    return moderate(posts(spark, sf_dir).select("doc_id", "data"), models, LEXICON)


@query
def moderated(spark, sf_dir):
    done = _moderated(spark, sf_dir)
    probs = [c for c in done.columns if c.endswith("prob") or c.endswith("probability")]
    return rounded(done, *probs)


def _streamed_documents(spark, sf_dir):
    """The table may be one file or a folder of files; a pattern stands for either, a plain path only for a folder."""
    return stream_posts(spark, f"{sf_dir}/documents.parque[t]", schema=SCHEMAS["documents"])


@query
def streamed_verdicts(spark, sf_dir):
    """The same plan on a stream of the files of documents."""
    tasks = ("spam", "hatespeech", "selfharm")
    models = fit_nb_tasks(labelled_tokens(spark, sf_dir), {t: t for t in tasks})
    stream = _streamed_documents(spark, sf_dir)
    done = moderate(stream.select("doc_id", F.col("text").alias("data")), models, LEXICON)
    out = fresh_path(spark, "stream")
    write_stream(done, f"{out}/verdicts", f"{out}/state").awaitTermination()
    back = spark.read.schema(done.schema).parquet(f"{out}/verdicts")
    return rounded(back, *[c for c in back.columns if c.endswith("prob") or c.endswith("probability")])


@query
def streamed_large_model(spark, sf_dir):
    """A stream scored, batch by batch, with a model of which a thousand tokens are broadcast."""
    model = fit_nb(labelled_tokens(spark, sf_dir), "hatespeech")
    stream = _streamed_documents(spark, sf_dir)
    stream = P.with_tokens(stream.select("doc_id", F.col("text").alias("data")))
    out = fresh_path(spark, "stream")

    def scored(batch):
        return score_nb(batch, model, broadcast_tokens=1000).select("doc_id", "log_odds", "prediction", "probability")

    write_batches(stream, scored, f"{out}/verdicts", f"{out}/state").awaitTermination()
    back = spark.read.schema("doc_id bigint, log_odds double, prediction int, probability double").parquet(f"{out}/verdicts/batch=*")
    return rounded(back, "log_odds", "probability")


# --- evaluation ------------------------------------------------------------


def _evaluated(spark, sf_dir):
    rows = labelled_tokens(spark, sf_dir)
    return score_nb(rows, fit_nb(rows, "hatespeech"))


@query
def accuracy(spark, sf_dir):
    return rounded(A.accuracy(_evaluated(spark, sf_dir), "hatespeech"), "accuracy")


@query
def confusion(spark, sf_dir):
    return A.confusion(_evaluated(spark, sf_dir), "hatespeech")


@query
def row_counts(spark, sf_dir):
    sets = R.split_task(toxic_labels(spark, sf_dir), 0.8, "doc_id", 7).select(F.col("split").alias("stage"))
    loaded = table(spark, sf_dir, "documents").select(F.lit("loaded").alias("stage"))
    return A.row_counts(R.concat(loaded, sets), "stage")


@query
def class_counts(spark, sf_dir):
    return A.class_counts(toxic_labels(spark, sf_dir))


@query
def loss_history(spark, sf_dir):
    """Steps from 0 on, a loss that is above zero and never rises."""
    history = A.loss_history(fit_logreg(labelled_tokens(spark, sf_dir), CONFIG, "hatespeech"))
    ordered = F.array_sort(F.collect_list(F.struct("iteration", "loss")))
    losses, steps = F.transform("h", lambda x: x["loss"]), F.transform("h", lambda x: x["iteration"])
    falls = F.forall(F.arrays_zip(F.slice(losses, 2, 1000).alias("a"), losses.alias("b")), lambda x: x["a"].isNull() | (x["a"] <= x["b"]))
    checks = (falls.alias("falls"), (F.array_min(losses) > 0).alias("positive"), (steps == F.sequence(F.lit(0), F.size("h") - 1)).alias("in_steps"))
    return history.agg(ordered.alias("h")).select(*checks, F.size("h").between(2, CONFIG.epochs + 1).alias("within_epochs"))


@query
def loss_history_saved(spark, sf_dir):
    """Held-out loss of naive Bayes as chunks of rows are added, from the loaded model."""
    folder = fresh_path(spark, "models")
    save_model(fit_nb_chunks(labelled_tokens(spark, sf_dir), "hatespeech"), folder, "hatespeech", spark)
    return rounded(A.loss_history(load_model(folder, "hatespeech", spark), spark), "loss")


@query
def evaluation_report(spark, sf_dir):
    """The self-harm classifier and its ensemble, side by side."""
    rows = labelled_tokens(spark, sf_dir)
    scored = score_task(rows, fit_nb(rows, "selfharm"), "selfharm", lexicon=LEXICON)
    return rounded(A.report(scored, ("prediction", "selfharm_pred"), "selfharm"), "accuracy")


# --- sinks -----------------------------------------------------------------


@query
def write_task(spark, sf_dir):
    rows = with_stand_in(posts(spark, sf_dir)).select("doc_id", "prediction", "probability", "data")
    done = P.rename_result(rows, "spam")
    path = IO.write_task(done, fresh_path(spark, "predictions"), "spam", "stories")
    return rounded(IO.read_posts(spark, path, schema=done.schema), "spam_prob")


@query
def write_fused(spark, sf_dir):
    done = _fused(spark, sf_dir)
    path = IO.write_fused(done, fresh_path(spark, "predictions"))
    back = IO.read_posts(spark, path, schema=done.schema)
    return rounded(back, *[c for c in back.columns if c.endswith("prob") or c.endswith("probability")])


@query
def write_split(spark, sf_dir):
    done = R.split_task(toxic_labels(spark, sf_dir), 0.8, "doc_id", 7)
    path = IO.write_split(done, fresh_path(spark, "sets"), "hatespeech", "parquet")
    return IO.read_posts(spark, path, "parquet", done.schema)


@query
def model_roundtrip(spark, sf_dir):
    """A saved and loaded naive Bayes scores all posts."""
    folder = fresh_path(spark, "models")
    save_model(fit_nb(labelled_tokens(spark, sf_dir), "hatespeech"), folder, "hatespeech", spark)
    scored = score_task(posts(spark, sf_dir), load_model(folder, "hatespeech", spark), "hatespeech")
    return rounded(scored.select("doc_id", "hatespeech_pred", "hatespeech_prob"), "hatespeech_prob")


# --- files by name ---------------------------------------------------------


def _workspace(spark, sf_dir) -> Workspace:
    """The given tables as files: a task set each, and stories."""
    home = fresh_path(spark, "work")
    rows = labelled(spark, sf_dir)
    for task in P.TASKS:
        sets = rows.select("doc_id", "data", F.col(task).alias("label"))
        sets.write.parquet(f"{home}/tasks/{task}")
    stories = table(spark, sf_dir, "documents")
    story = (F.col("text").alias("data"), F.lit(0).alias("label"), F.col("doc_id").cast("string").alias("story_id"))
    stories.select(*story).write.parquet(f"{home}/stories")
    folders = [f"{home}/{name}" for name in ("tasks", "sets", "models", "results", "stories")]
    return Workspace(
        spark,
        *folders,
        fmt="parquet",
        settings={task: Settings("nb") for task in P.TASKS},
        key="doc_id",
        task_schema="doc_id bigint, data string, label int",
    )


@query
def named_sets(spark, sf_dir):
    work = _workspace(spark, sf_dir)
    work.split(0.8, seed=7)
    made = [
        work.load(name, task).withColumns({"task": F.lit(task), "set": F.lit(name)})
        for task in P.TASKS
        for name in ("train_set", "test_set")
    ]
    return R.concat(*made)


@query
def stories_to_verdicts(spark, sf_dir):
    """Train on whole task files, save, load, and moderate the stories."""
    work = _workspace(spark, sf_dir)
    for task in P.TASKS:
        work.train(task, spark.read.schema(work.task_schema).parquet(f"{work.tasks}/{task}"))
    done = work.moderate("stories", save=True, normalize=True, lexicon=LEXICON)
    return rounded(done, *[c for c in done.columns if c.endswith("prob") or c.endswith("probability")])
