"""Projection, normalisation, formatting and splitting of instruction examples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusops.functions.text import SPACE, is_blank, join_text, pieces, present, py_words, word_count
from corpusops.plans.scale import dense_positions, first_by_hash, join_same
from corpusops.plans.scale import head as first_positions

# fixed values: prompt texts and templates the formats are defined by
SCHEMA_PREFIX = "Table Schema: "
CHAT_SYSTEM = "You are an expert SQL developer who generates accurate and efficient SQL queries."
COMPLETION_HEAD = "### SQL Request:\n"
COMPLETION_TAIL = "\n\n### SQL Query:\n"
TRAINING_SYSTEM = "You are an expert assistant."
# family -> (name fragments, text before the instruction, between prompt and answer, after the answer)
TRAINING_TEMPLATES = {
    "llama-3": (
        ("llama-3",),
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>" + TRAINING_SYSTEM
        + "<|eot_id|><|start_header_id|>user<|end_header_id|>",
        "<|eot_id|><|start_header_id|>assistant<|end_header_id|>",
        "<|eot_id|><|end_of_text|>",
    ),
    "mistral": (("mistral", "mixtral"), "<s>[INST] ", " [/INST] ", "</s>"),
    "phi-3": (("phi-3",), "<|system|>" + TRAINING_SYSTEM + "<|end|><|user|>", "<|end|><|assistant|>", "<|end|>"),
}
GENERIC_TEMPLATE = ("### Instruction:\n", "\n\n### Input:\n", "\n\n### Response:\n")
# first column that exists wins
FIELD_ALIASES = {
    "instruction": ("question", "instruction"),
    "input": ("context", "input"),
    "output": ("answer", "output"),
}
# request constraints: column -> (default, low, high)
REQUEST_LIMITS = {"max_tokens": (256, 1, 2048), "temperature": (0.7, 0.0, 2.0), "top_p": (0.9, 0.0, 1.0)}
CHAT_PARTS = {"system": "System: ", "user": "User: ", "assistant": "Assistant: "}


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def make_examples(df: DataFrame, instruction: str, schema: str, query: str,
                  explanation: str | None = None, difficulty: str | None = None) -> DataFrame:
    """Example rows from columns; the input becomes ``Table Schema: <schema>``."""
    return df.select(
        "*",
        F.col(instruction).alias("instruction"),
        join_text(SCHEMA_PREFIX, F.col(schema)).alias("input"),
        F.col(query).alias("output"),
        (F.coalesce(F.col(explanation), F.lit("")) if explanation else F.lit("")).alias("explanation"),
        (F.coalesce(F.col(difficulty), F.lit("medium")) if difficulty else F.lit("medium")).alias("difficulty"),
    )


def normalise_fields(df: DataFrame, aliases: Mapping[str, Sequence[str]] = FIELD_ALIASES,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Rename foreign field names. The fallback is chosen by which columns exist, not per value."""
    chosen = []
    for target, names in aliases.items():
        source = next((n for n in names if n in df.columns), None)
        chosen.append((_text(source) if source else F.lit("")).alias(target))
    return df.select(*keep, *chosen)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.where("instruction <> '' AND output <> ''")


def dense_id(df: DataFrame, order: Sequence[str], out: str = "id") -> DataFrame:
    """Zero-based consecutive id in source order."""
    return dense_positions(df, order, out)


def to_format(df: DataFrame, fmt: str, keep: Sequence[str] = ()) -> DataFrame:
    """``alpaca``, ``chat`` or ``completion`` rows."""
    ask = join_text(F.col("instruction"), "\n\n", F.col("input"))
    if fmt == "alpaca":
        return df.select(*keep, "instruction", "input", "output")
    if fmt == "chat":
        turns = [("system", F.lit(CHAT_SYSTEM)), ("user", ask), ("assistant", F.col("output"))]
        messages = F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns])
        return df.select(*keep, messages.alias("messages"))
    if fmt == "completion":
        return df.select(
            *keep,
            join_text(COMPLETION_HEAD, ask, COMPLETION_TAIL).alias("prompt"),
            F.col("output").alias("completion"),
        )
    raise ValueError(f"unknown format: {fmt}")


def convert_format(df: DataFrame, src: str, dst: str, keep: Sequence[str] = (), position: str | None = None) -> DataFrame:
    """Convert between the three formats.

    ``chat`` and ``completion`` join instruction and input with a blank line, so going back splits
    at the first blank line followed by ``Table Schema:``; without one, at the first blank line. A
    chat gives one row per answer.

    ``position`` names a column with the length of the instruction. It is added to chats and completions and used on the way back, so
    that no text is lost or moved whatever blank lines it has; where a source has no such column, or no blank line there, the rule above holds.
    """
    carried = [position] if position and src != "alpaca" and position in df.columns else []
    if src == "alpaca":
        flat = df
    elif src in ("chat", "completion"):
        if src == "chat":
            # one row per answer, with the last question before it
            asked = lambda i: F.filter(F.slice("messages", 1, i), lambda m: m["role"] == "user")
            answered = F.transform("messages", lambda m, i: F.when(m["role"] == "assistant", F.struct(
                F.try_element_at(asked(i), F.lit(-1))["content"].alias("ask"), m["content"].alias("answer"))))
            df = df.select(*keep, *carried, F.inline(F.array_compact(answered)))
            ask, answer = F.col("ask"), F.col("answer")
        else:
            inside = F.length("prompt") - len(COMPLETION_HEAD) - len(COMPLETION_TAIL)
            ask, answer = F.substring("prompt", F.lit(len(COMPLETION_HEAD) + 1), inside), F.col("completion")
        split = df.select(*keep, *carried, ask.alias("ask"), answer.alias("output"))
        known = [F.when(F.substring("ask", F.col(c) + 1, F.lit(2)) == "\n\n", F.col(c) + 1) for c in carried]
        at = F.coalesce(
            *known,
            F.nullif(F.locate("\n\n" + SCHEMA_PREFIX, F.col("ask")), F.lit(0)),
            F.locate("\n\n", F.col("ask")),
        )
        flat = split.withColumn("at", at).select(
            *keep,
            F.when(F.col("at") > 0, F.substring("ask", F.lit(1), F.col("at") - 1))
            .otherwise(F.col("ask")).alias("instruction"),
            F.when(F.col("at") > 0, F.substring("ask", F.col("at") + 2, F.length("ask")))
            .otherwise(F.lit("")).alias("input"),
            "output",
        )
    else:
        raise ValueError(f"unknown format: {src}")
    if position and dst != "alpaca":
        return to_format(flat.withColumn(position, F.length("instruction")), dst, [*keep, position])
    return to_format(flat, dst, keep)


def model_family(model_name: str) -> str:
    lowered = model_name.lower()
    for family, (fragments, *_rest) in TRAINING_TEMPLATES.items():
        if any(f in lowered for f in fragments):
            return family
    return "generic"


def _render(family: str) -> Column:
    instruction, given, output = F.col("instruction"), F.col("input"), F.col("output")
    if family == "generic":
        head, before_input, before_answer = GENERIC_TEMPLATE
        return F.when(is_blank("input"), join_text(head, instruction, before_answer, output)).otherwise(
            join_text(head, instruction, before_input, given, before_answer, output)
        )
    _names, head, before_answer, tail = TRAINING_TEMPLATES[family]
    ask = F.when(is_blank("input"), instruction).otherwise(join_text(instruction, "\n\n", given))
    return join_text(head, ask, before_answer, output, tail)


def render_training_text(df: DataFrame, model_name: str, fmt: str = "alpaca",
                         keep: Sequence[str] = ()) -> DataFrame:
    """Training ``text`` in the template of the model's family."""
    if fmt != "alpaca":
        raise ValueError(f"unsupported training format: {fmt}")
    return df.select(*keep, _render(model_family(model_name)).alias("text"))


def split(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Label rows ``test`` (exactly ``ceil(fraction * n)`` of them) or ``train``."""
    if not fraction:
        return df.withColumn("split", F.lit("train"))
    flagged = first_by_hash(df, key, lambda n: F.ceil(F.lit(fraction) * n), seed=seed)
    return flagged.withColumn("split", F.when(F.col("selected"), "test").otherwise("train")).drop("selected")


def normalise_test(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The three fields, missing ones as empty text."""
    names = ("instruction", "input", "output")
    return df.select(*keep, *[(_text(n) if n in df.columns else F.lit("")).alias(n) for n in names])


def eval_prompt(df: DataFrame) -> DataFrame:
    """Evaluation prompt, with an input block only where the input is not blank."""
    bare = join_text("Instruction: ", F.col("instruction"), "\n\nResponse:")
    full = join_text("Instruction: ", F.col("instruction"), "\n\nInput: ", F.col("input"), "\n\nResponse:")
    return df.withColumn("prompt", F.when(is_blank("input"), bare).otherwise(full))


def head(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in order; 0 or None keeps all.

    Rows are cut into runs by key, and only runs up to the one that holds row ``n`` are shuffled and ranked.
    """
    return df if not n else first_positions(df, order, n, "__position").drop("__position")


def chat_parts(df: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The parts of each conversation's prompt as rows ``conv, turn, closing, part``: in this order they join with a blank line.

    This form is distributed by rows, however long a conversation is.
    """
    label = F.lit(None).cast("string")
    for role, prefix in CHAT_PARTS.items():
        label = F.when(F.col("role") == role, F.lit(prefix)).otherwise(label)
    parts = df.select(conv, F.col(turn).alias("__turn"), F.concat(label, F.col("text")).alias("__part"))
    last = df.groupBy(conv).agg(F.max(turn).alias("__turn")).select(
        conv, "__turn", F.lit("Assistant:").alias("__part")
    )
    # the closing part sorts after the last turn's own text
    rows = parts.withColumn("closing", F.lit(0)).union(last.withColumn("closing", F.lit(1)))
    return rows.where("__part IS NOT NULL").select(conv, F.col("__turn").alias("turn"), "closing", F.col("__part").alias("part"))


def chat_prompt(df: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One prompt per conversation, ending in ``Assistant:``. A row holds its whole conversation; see ``chat_parts`` for rows."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "closing", "part")))
    return chat_parts(df, conv, turn).groupBy(conv).agg(F.array_join(F.transform(ordered, lambda r: r["part"]), "\n\n").alias("prompt"))


def token_usage(df: DataFrame, prompt: str, completion: str) -> DataFrame:
    """Whitespace token counts of prompt, completion and both."""
    counted = df.withColumn("prompt_tokens", F.coalesce(word_count(prompt), F.lit(0))).withColumn(
        "completion_tokens", F.coalesce(word_count(completion), F.lit(0))
    )
    return counted.withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))


def chat_token_usage(messages: DataFrame, replies: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Chat usage: prompt tokens summed over all messages of the conversation."""
    asked = messages.groupBy(conv).agg(F.sum(word_count("text")).alias("prompt_tokens"))
    given = replies.groupBy(conv).agg(F.sum(word_count("text")).alias("completion_tokens"))
    joined = asked.join(given, conv, "left").fillna(0, ["completion_tokens"])
    return joined.withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))


def truncate_tokens(df: DataFrame, column: str, budget: int) -> DataFrame:
    """Cut texts of more than ``budget`` whitespace tokens at the end of the last one, and flag them; others stay as they are."""
    too_long = F.size(py_words(F.col(column))) > budget
    cut = F.regexp_extract(column, rf"^(?:{SPACE}*+[^{SPACE[1:]}++){{{budget}}}", 0)
    return df.withColumn("truncated", too_long).withColumn(column, F.when(F.col("truncated"), cut).otherwise(F.col(column)))


def check_requests(df: DataFrame, limits: Mapping[str, tuple] = REQUEST_LIMITS) -> DataFrame:
    """Fill request defaults and list the constraints each request breaks."""
    filled = df
    checks = [("prompt", F.col("prompt").isNull())]
    for name, (default, low, high) in limits.items():
        value = F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)
        filled = filled.withColumn(name, value)
        checks.append((name, ~F.col(name).between(low, high)))
    return filled.withColumn("violations", present(checks))


def request_violations(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return check_requests(df).select(*keep, F.explode("violations").alias("field"))


def phrase_table(spark: SparkSession, phrases: Mapping[str, str]) -> DataFrame:
    """A dictionary as rows ``old, new``."""
    return spark.createDataFrame(list(phrases.items()), "old string, new string")


def _phrase_key(phrase: str) -> Column:
    """What every text with the phrase holds: the phrase's first run of word characters, which is a whole run there too; of phrases without one, their first mark."""
    run = F.regexp_extract(phrase, r"\w+", 0)
    return F.when(run != "", run).otherwise(F.regexp_extract(phrase, r"[^\w\s]", 0))


def augment(df: DataFrame, synonyms: Mapping[str, str] | DataFrame, periods: Mapping[str, str] | DataFrame = MappingProxyType({}),
            key: str = "id") -> DataFrame:
    """Originals plus one variant per replacement that occurs, applied to all three fields alike.

    Replacements are whole words: no letter, digit or underscore touches them. Both sides are taken literally; phrases of white space are left out. Dictionaries are tables
    ``old, new`` (or small mappings) of any size: the word runs of a row are joined with the first runs of the phrases, which touches ids
    and words only, and a row meets the few phrases found so for the exact test. The plan does not grow with the dictionary.
    """
    fields = ("instruction", "input", "output")
    spark = df.sparkSession
    tables = [t if isinstance(t, DataFrame) else phrase_table(spark, t) for t in (synonyms, periods)]
    phrases = tables[0].select("old", "new").union(tables[1].select("old", "new")).withColumn("__run", _phrase_key("old")).where("__run <> ''").distinct()
    text = F.concat_ws("\n", *fields)
    held = F.concat(pieces(text, r"\W+"), F.array_distinct(F.split(F.regexp_replace(text, r"[\w\s]+", ""), "")))
    runs = df.select(key, F.explode(F.array_distinct(held)).alias("__run"))
    candidates = runs.join(phrases, "__run").select(key, "old", "new").distinct()

    pattern = F.concat(F.lit(r"(?<!\w)\Q"), F.replace("old", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?!\w)"))
    into = F.regexp_replace("new", r"([\\$])", r"\\$1")
    met = join_same(df.select(key, *fields), candidates.select(key, pattern.alias("__pattern"), into.alias("__into"), F.concat("old", F.lit("->"), "new").alias("variant")), [key])
    found = reduce(Column.__or__, [F.coalesce(F.regexp_like(f, F.col("__pattern")), F.lit(False)) for f in fields])
    changed = [F.regexp_replace(f, F.col("__pattern"), F.col("__into")).alias(f) for f in fields]
    variants = met.where(found).select(key, "variant", *changed)
    original = df.select(key, F.lit("original").alias("variant"), *fields)
    return original.union(variants).where("instruction IS NOT NULL")


def class_shares(df: DataFrame, by: str) -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(by).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over one row per class
    return counts.select(by, "n", (F.col("n") / total).alias("share"))


def balance(df: DataFrame, by: str, key: str, target: int | None = None, seed: int = 42) -> DataFrame:
    """Downsample every class to ``target`` rows (default: the smallest class), by hash order."""
    if target is None:
        least = df.groupBy(by).count().agg(F.min("count")).scalar()
    else:
        least = F.lit(target)
    flagged = first_by_hash(df, key, lambda n: F.least(n, least), by=[by], seed=seed)
    return flagged.where("selected").drop("selected")
