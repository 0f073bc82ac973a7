"""Evaluation assembly: role prompts, predictions, judge prompts and
scores, translations, and user functions (J1-J3, J5, W4, W5, A11, C15,
G1, G4).

Groups here are bounded by construction (one judge batch, one
conversation's turns, one row's models); everything else is joins.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.functions import text as TX
from weft.session import materialize

# Judge instructions and line formats of the evaluation harness.
PAIR_RATING_PROMPT = (
    "For each of the questions, give a rating on scale of 10 to the gpt answer and model answer respectively "
    "based on the reference answer, and output the average final score in the following format:\n"
    "```Question 1: gpt score: int,  model score: int\n Question 2: gpt score: int,  model score: int\n "
    "Question 3: gpt score: int,  model score: int\n ... gpt average: int, model average: int\n```"
    "                    \n")
BATCH_RATING_PROMPT = (
    "For each of the questions, give a rating on scale of 100 to the models' answer respectively based on the "
    "reference answer in the following format:\n"
    "```Question 1: model1 score: int,  model2 score: int\nQuestion 2: model1 score: int,  model2 score: int\n"
    "Question 3: model1 score: int,  model2 score: int\n```                    \n")
JUDGE_BATCH = 8


# -- J1 -------------------------------------------------------------------------
def attach_role_prompts(questions: DataFrame, prompts: DataFrame, role: str = "role", question: str = "question",
                        on_missing: str = "error") -> tuple[DataFrame, DataFrame]:
    """Look up each row's role in ``prompts`` (role, prompt) and build
    ``prompt + question + "\\noutput: "``.  Returns (joined, missing roles).
    ``on_missing='error'`` raises when any role has no prompt."""
    p = prompts.select(role, "prompt")
    missing = questions.select(role).distinct().join(p, role, "left_anti")
    if on_missing == "error":
        bad = [r[0] for r in missing.limit(20).collect()]
        if bad:
            raise KeyError(f"roles without a prompt: {bad}")
    joined = questions.join(p, role, "inner").withColumn(
        "combined_question", F.concat(F.col("prompt"), F.col(question), F.lit("\noutput: ")))
    return joined, missing


# -- J2 -------------------------------------------------------------------------
def attach_predictions(rows: DataFrame, predictions: DataFrame, keys: list[str], model: str = "model",
                       text: str = "text") -> DataFrame:
    """``predict`` MAP<model, text> per evaluation row (one entry per
    model; the per-row group is bounded by the number of models)."""
    m = predictions.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(model, text))).alias("predict"))
    return rows.join(m, keys, "left")


# -- J3 / W5 --------------------------------------------------------------------
def align_answers(questions: DataFrame, references: DataFrame, first: DataFrame, second: DataFrame,
                  keys: list[str]) -> DataFrame:
    """Positional alignment as an explicit inner join on ``keys``."""
    return questions.join(references, keys).join(first, keys).join(second, keys)


def pair_rating_prompts(aligned: DataFrame, group: str, order: str, question: str = "question",
                        reference: str = "reference", first: str = "gpt_answer", second: str = "model_answer",
                        header: str = PAIR_RATING_PROMPT) -> DataFrame:
    """One rating request per ``group`` (a conversation): header + one
    line per turn with question, reference and the two answers."""
    line = F.concat(F.lit("Question: "), F.col(question), F.lit(" Reference answer: "), F.col(reference),
                    F.lit(" GPT answer: "), F.col(first), F.lit(" Model answer: "), F.col(second), F.lit("\n"))
    g = aligned.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))).alias("_ls"))
    return g.select(group, F.concat(F.lit(header), F.array_join(F.transform("_ls", lambda x: x["l"]), "")).alias("rating_prompt"))


# -- W4 / C15 / A11 ------------------------------------------------------------------
def judge_batches(rows: DataFrame, idx: str, question: str, reference: str, answers: list[str],
                  batch_size: int = JUDGE_BATCH, header: str = BATCH_RATING_PROMPT) -> tuple[DataFrame, DataFrame]:
    """Rows numbered by ``idx`` (dense, 0-based) go to batch
    ``idx div batch_size``; one prompt per batch lists each member's question,
    reference and every model's answer.  Returns (members, prompts)."""
    m = rows.withColumn("batch", F.floor(F.col(idx) / batch_size).cast("bigint")) \
            .withColumn("member", (F.pmod(F.col(idx), F.lit(batch_size)) + 1).cast("int"))
    parts = [F.lit("Question: "), F.col(question), F.lit(" Reference answer: "), F.col(reference), F.lit(" ")]
    for j, a in enumerate(answers):
        parts += [F.lit(f"model{j + 1} answer: "), F.col(a), F.lit(" ")]
    parts.append(F.lit("\n"))
    g = m.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct(F.col("member").alias("o"), F.concat(*parts).alias("l")))).alias("_ls"))
    prompts = g.select("batch", F.concat(F.lit(header), F.array_join(F.transform("_ls", lambda x: x["l"]), "")).alias("judge_prompt"))
    return m, prompts


def parse_judge(texts: DataFrame, key: str, text: str = "judge_text", n_models: int = 2) -> DataFrame:
    """Per line, question number and integer scores; a later line for
    the same question overrides an earlier one.  -> (key, member, score_1..n).
    A number too long for an integer is no score (null), nor a question."""
    pat = TX.judge_line_pattern(n_models)
    lines = texts.select(key, F.posexplode(F.split(F.col(text), "\n", -1)).alias("_ln", "_l"))
    lines = lines.where(F.col("_l").rlike(pat))
    cols = [F.regexp_extract("_l", pat, j + 2).try_cast("int").alias(f"score_{j + 1}") for j in range(n_models)]
    parsed = lines.select(key, "_ln", F.regexp_extract("_l", pat, 1).try_cast("int").alias("member"), *cols)
    parsed = parsed.where(F.col("member").isNotNull())
    last = parsed.groupBy(key, "member").agg(F.max_by(F.struct(*[f"score_{j + 1}" for j in range(n_models)]), F.col("_ln")).alias("_s"))
    return last.select(key, "member", *[F.col("_s")[f"score_{j + 1}"].alias(f"score_{j + 1}") for j in range(n_models)])


def judge_scores(members: DataFrame, parsed: DataFrame, key: str = "batch", n_models: int = 2) -> DataFrame:
    """Scores per member row; unparsed members get -1 for every model."""
    j = members.join(parsed, [key, "member"], "left")
    for i in range(n_models):
        j = j.withColumn(f"score_{i + 1}", F.coalesce(F.col(f"score_{i + 1}"), F.lit(-1)))
    return j


#: No group of a text join has more than this part of the rows.
HOT_SHARE = 1024


def _join_by_text(rows: DataFrame, table: DataFrame, on: str, by: list[str], hot_share: int = HOT_SHARE) -> DataFrame:
    """Left join on a text that may be most rows' own; ``table`` has one row a text.

    The texts that make up 1 / ``hot_share`` of the rows or more (at most
    ``hot_share``, whatever the data: they are broadcast) come from a sketch of
    one pass, which may add some that are rarer.  Each gets as many salts as
    keep a group below that share; its rows take one by the hash of ``by``, its
    table row is there for each.  The others have one salt, rows without a
    text any."""
    sketch = rows.where(F.col(on).isNotNull()).agg(F.expr(f"approx_top_k(`{on}`, {hot_share}, {8 * hot_share})").alias("top"), F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(sketch.select(F.explode("top").alias("t"), "n").where(F.col("t.count") * hot_share >= F.col("n"))
                      .select(F.col("t.item").alias(on), F.ceil(F.col("t.count") * hot_share / F.col("n")).cast("int").alias("_salts")))
    salts = F.coalesce("_salts", F.when(F.col(on).isNull(), hot_share).otherwise(1))
    left = rows.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*by), salts).cast("int"))
    right = (table.where(F.col(on).isNotNull()).join(hot, on, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))))
    return (left.drop("_salts").join(right.drop("_salts"), [on, "_salt"], "left")
            .select(*rows.columns, *[c for c in table.columns if c != on]))


# -- J5 -------------------------------------------------------------------------
def apply_translations(turns: DataFrame, translations: DataFrame, keys: list[str], turn_map: str = "turn",
                       source: str = "source", target: str = "target",
                       allow_keys=TX.ALLOWED_KEY_SUBSTRINGS) -> DataFrame:
    """Translate every value of each accepted turn (F4) through a
    (source, target) table.  A value fails when its translation is missing
    or a placeholder; each failure records the original turn as missing; a
    turn keeps its translation when more than one value succeeded,
    otherwise its partial translation is recorded as missing.  Returns long
    rows ``(keys..., output, seq, entry MAP)`` with output 'chats' or
    'missing'; ``seq`` orders the missing entries of a turn."""
    t = turns.where(TX.turn_passes(F.col(turn_map), allow_keys))
    # the whole turn goes with its first value only
    kv = (t.select(*keys, turn_map, F.posexplode(F.map_entries(F.col(turn_map))).alias("_k", "_e"))
          .select(*keys, F.when(F.col("_k") == 0, F.col(turn_map)).alias("_orig"), "_k", F.col("_e")["key"].alias("_key"), F.col("_e")["value"].alias("_val")))
    # one translation a source, whatever the table repeats
    tr = translations.groupBy(F.col(source).alias("_val")).agg(F.min(target).alias("_tr"))
    kv = _join_by_text(materialize(kv, "values"), tr, "_val", [*keys, "_k"])   # read by the sketch and by the join
    ok = F.col("_tr").isNotNull() & ~TX.strip_ws(F.col("_tr")).isin(*TX.TRANSLATION_PLACEHOLDERS)
    g = kv.withColumn("_ok", ok).groupBy(*keys).agg(
        F.any_value("_orig", True).alias("_orig"),
        F.array_sort(F.collect_list(F.struct("_k", "_key", "_ok", TX.strip_ws(F.col("_tr")).alias("_t")))).alias("_xs"))
    good = F.filter("_xs", lambda x: x["_ok"])
    new = F.map_from_entries(F.transform(good, lambda x: F.struct(x["_key"], x["_t"])))
    g = g.withColumn("_new", new).withColumn("_nfail", F.size(F.filter("_xs", lambda x: ~x["_ok"])))

    def entry(output, seq, m):
        return F.struct(F.lit(output).alias("output"), seq.cast("int").alias("seq"), m.alias("entry"))

    none = F.array().cast("array<struct<output:string,seq:int,entry:map<string,string>>>")
    chats = F.when(F.size("_new") > 1, F.array(entry("chats", F.lit(0), F.col("_new")))).otherwise(none)
    fails = F.when(F.col("_nfail") > 0, F.transform(F.sequence(F.lit(0), F.col("_nfail") - 1),
                                                    lambda i: entry("missing", i, F.col("_orig")))).otherwise(none)
    partial = F.when(F.size("_new") <= 1, F.array(entry("missing", F.col("_nfail"), F.col("_new")))).otherwise(none)
    # all outputs of a turn from one pass over the grouped turns
    out = g.select(*keys, F.explode(F.concat(chats, fails, partial)).alias("_o"))
    return out.select(*keys, "_o.output", "_o.seq", "_o.entry")


# -- G1 / G4 ------------------------------------------------------------------
def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """G1: a user batch function over Arrow batches of each partition."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def batch_predict(df: DataFrame, keys: list[str], prompt: str, models: dict[str, Callable],
                  history: str | None = None) -> DataFrame:
    """Every model answers every row, all in one pass of ``mapInPandas``;
    output long (keys, model, text) for :func:`attach_predictions`.

    A model takes the list of prompts; with ``history`` (an array column of
    earlier turns, oldest first) it takes that list too."""
    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)

    def run(it):
        for pdf in it:
            prompts = pdf[prompt].fillna("").tolist()
            chats = ([list(h) if h is not None else [] for h in pdf[history]],) if history else ()
            for name, predict in models.items():
                yield pdf[keys].assign(model=name, text=list(predict(prompts, *chats)))

    return df.select(*keys, prompt, *([history] if history else [])).mapInPandas(run, f"{key_schema}, model string, text string")
