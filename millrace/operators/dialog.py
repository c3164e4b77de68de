"""Conversations as arrays of (role, content): cleaning, pairing, merging, rendering.

A dialog is one array in one row, built by an ordered aggregation, so that every step is a fold over that array inside
the JVM and no step shuffles again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import strip

TURNS = "array<struct<role:string,content:string>>"
#: Other names of roles.
ROLES = {"human": "user", "model": "assistant", "gpt": "assistant"}
MODEL_ROLES = {"user": "user", "human": "user", "assistant": "model", "model": "model", "gpt": "model"}
LANGUAGES = {"en": "english", "eng": "english", "sw": "swahili", "swa": "swahili", "kiswahili": "swahili"}


def mapped(value: Column, names: dict[str, str], otherwise: Column | None = None) -> Column:
    """A value by table; values outside it as they are, or otherwise."""
    out = value if otherwise is None else otherwise
    for name, other in names.items():
        out = F.when(value == name, other).otherwise(out)
    return out


def role_name(role: Column) -> Column:
    """user, assistant, or the lower-cased role as it is."""
    return mapped(F.lower(role), ROLES)


def gather(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """One row per conversation: key, messages in order."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("place"), F.col("role"), F.col("text").alias("content"))))
    return turns.groupBy(key).agg(listed.alias("listed")).select(key, F.transform("listed", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages"))


def clean(messages: Column) -> Column:
    """User and assistant turns with content, roles in one spelling, content stripped."""
    named = F.transform(messages, lambda t: F.struct(role_name(t["role"]).alias("role"), strip(F.coalesce(t["content"], F.lit(""))).alias("content")))
    return F.filter(named, lambda t: t["role"].isin("user", "assistant") & (t["content"] != ""))


def _last_where(turns: Column, test) -> Column:
    return F.try_element_at(F.filter(turns, test), F.lit(-1))["content"]


def last_pair(messages: Column) -> Column:
    """(user, assistant): the last user turn, and the last assistant turn that has any user turn before it; else null."""
    first_user = F.coalesce(F.array_position(F.transform(messages, lambda t: t["role"]), "user"), F.lit(0))
    answers = F.filter(messages, lambda t, i: (t["role"] == "assistant") & (first_user > 0) & (i + 1 > first_user))
    user, answer = _last_where(messages, lambda t: t["role"] == "user"), F.try_element_at(answers, F.lit(-1))["content"]
    return F.when(user.isNotNull() & answer.isNotNull(), F.struct(user.alias("user"), answer.alias("assistant")))


def first_pair(messages: Column) -> Column:
    """(user, assistant): the first user turn and the first assistant turn after it; else null."""
    first_user = F.coalesce(F.array_position(F.transform(messages, lambda t: t["role"]), "user"), F.lit(0))
    user = F.try_element_at(F.filter(messages, lambda t: t["role"] == "user"), F.lit(1))["content"]
    answer = F.try_element_at(F.filter(messages, lambda t, i: (t["role"] == "assistant") & (i + 1 > first_user)), F.lit(1))["content"]
    return F.when(user.isNotNull() & answer.isNotNull(), F.struct(user.alias("user"), answer.alias("assistant")))


def merge_adjacent(messages: Column) -> Column:
    """Neighbouring turns of one role as one turn, joined by line breaks."""
    start = F.array().cast(TURNS)

    def step(done: Column, turn: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(turn["role"].alias("role"), strip(F.concat(last["content"], F.lit("\n"), turn["content"])).alias("content"))
        same = F.coalesce(last["role"] == turn["role"], F.lit(False))
        return F.when(same, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(F.struct(turn["role"].alias("role"), turn["content"].alias("content")))))

    return F.aggregate(messages, start, step)


def alternating(messages: Column, first: str = "user", last: str = "assistant") -> Column:
    """The merged dialog from its first user turn on, if it ends with an answer; else empty.

    Merging leaves no two neighbours of one role, so that a dialog of two roles alternates by itself.
    """
    merged = merge_adjacent(F.filter(messages, lambda t: t["role"].isin(first, last)))
    begin = F.array_position(F.transform(merged, lambda t: t["role"]), first)
    rest = F.when(F.coalesce(begin, F.lit(0)) > 0, F.slice(merged, begin.cast("int"), F.size(merged))).otherwise(F.array().cast(TURNS))
    return F.when(F.try_element_at(rest, F.lit(-1))["role"] == last, rest).otherwise(F.array().cast(TURNS))


def dialog_messages(messages: Column, instruction: Column, response: Column, *, merge: bool = True) -> Column:
    """A row's dialog: its cleaned messages, else instruction and response; merged into alternating turns, or as it is."""
    one, two = (strip(F.coalesce(c, F.lit(""))) for c in (instruction, response))
    pair = F.array(F.struct(F.lit("user").alias("role"), one.alias("content")), F.struct(F.lit("assistant").alias("role"), two.alias("content")))
    own = clean(F.coalesce(messages, F.array().cast(TURNS)))
    raw = F.when(F.size(own) > 0, own).when((one != "") & (two != ""), pair).otherwise(F.array().cast(TURNS))
    return alternating(raw) if merge else raw


def inject_system(messages: Column, prompt: str) -> Column:
    """With a system turn in front where there is none."""
    opening = F.coalesce(F.get(messages, F.lit(0))["role"], F.lit(""))
    system = F.array(F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content")))
    return F.when(opening.isin("system", "developer"), messages).otherwise(F.concat(system, messages))


def render(messages: Column, *, start: str = "<|im_start|>", end: str = "<|im_end|>") -> Column:
    """The dialog between markers, a line break after each turn."""
    return F.array_join(F.transform(messages, lambda t: F.concat(F.lit(start), t["role"], F.lit("\n"), t["content"], F.lit(end + "\n"))), "")


def marker_count(text: Column, marker: str) -> Column:
    """How often a marker occurs."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(marker), F.lit("")))) / len(marker)).cast("long")


def has_answer(text: Column, marker: str = "<|im_start|>assistant\n") -> Column:
    """Whether there is more than one character behind the answer's marker."""
    at = F.locate(marker, text)
    return (at > 0) & (F.length(text) - at - len(marker) + 1 > 1)


def splice(whole: Column, prompt: Column) -> Column:
    """What a rendering has behind its prompt; null where it doesn't begin with it."""
    return F.when(F.startswith(whole, prompt), whole.substr(F.length(prompt) + 1, F.length(whole)))


def language_name(language: Column, default: str) -> Column:
    """A language in one spelling; unknown ones as they are."""
    given = strip(F.coalesce(F.nullif(language, F.lit("")), F.lit(default)))
    return mapped(F.lower(given), LANGUAGES, given)


def canonical_rows(rows: DataFrame, key: str, *, index: str = "row_index", language: str = "language", source: str = "source", ids: tuple[str, ...] = ("source_id", "id"), default_language: str = "english") -> DataFrame:
    """rows with messages to the canonical layout; rows without a pair are dropped. ids: columns in order of precedence."""
    pair = last_pair(F.col("messages"))
    given = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ids if c in rows.columns]
    name = strip(F.coalesce(*given, F.concat(F.lit(f"{key}-"), F.col(index).cast("string"))))
    origin = F.coalesce(F.nullif(strip(F.coalesce(F.col(source), F.lit(""))), F.lit("")), F.lit(key)) if source in rows.columns else F.lit(key)
    tongue = F.col(language) if language in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("pair", pair).filter("pair is not null").select("messages", F.col("pair.user").alias("instruction"), F.col("pair.assistant").alias("response"), language_name(tongue, default_language).alias("language"), origin.alias("source"), name.alias("source_id"))


def model_turns(turns: Column) -> Column:
    """Turns with the roles user and model; others and empty ones dropped."""
    named = F.transform(turns, lambda t: F.struct(mapped(F.lower(t["role"]), MODEL_ROLES, F.lit(None).cast("string")).alias("role"), strip(F.coalesce(t["content"], F.lit(""))).alias("content")))
    return F.filter(named, lambda t: t["role"].isNotNull() & (t["content"] != ""))


def preference_pairs(rows: DataFrame) -> DataFrame:
    """Rows with prompt, chosen, rejected (arrays or null) and instruction, chosen_text, rejected_text to pairs.

    A pair needs a prompt that ends with the user and a chosen answer that begins with the model; the rejected answer's
    first role isn't checked.
    """
    one = lambda role, text: F.when(strip(F.coalesce(F.col(text), F.lit(""))) != "", F.array(F.struct(F.lit(role).alias("role"), strip(F.col(text)).alias("content"))))
    either = lambda turns, role, text: F.coalesce(F.when(F.size(model_turns(F.col(turns))) > 0, model_turns(F.col(turns))), one(role, text))
    rest = [c for c in rows.columns if c not in ("prompt", "chosen", "rejected", "instruction", "chosen_text", "rejected_text")]
    made = rows.select(*rest, either("prompt", "user", "instruction").alias("prompt"), either("chosen", "model", "chosen_text").alias("chosen"), either("rejected", "model", "rejected_text").alias("rejected"))
    ends = F.try_element_at("prompt", F.lit(-1))["role"] == "user"
    begins = F.get("chosen", F.lit(0))["role"] == "model"
    return made.filter(F.col("prompt").isNotNull() & F.col("chosen").isNotNull() & F.col("rejected").isNotNull() & ends & begins)


def pair_gate(valid: Column, prompt: Column, chosen: Column, rejected: Column, n_prompt: Column, n_chosen: Column, n_rejected: Column, *, most_prompt: int, most_completion: int, most_total: int) -> Column:
    """What becomes of a preference pair: the first outcome that holds, else kept.

    valid: whether the row is a pair; prompt, chosen and rejected: rendered texts, null where the rendering can't be
    spliced; n_: their tokens. The bounds are on the prompt, the longer completion, and both together.
    """
    longest = F.greatest(n_chosen, n_rejected)
    # fixed values: the outcomes, in the order of the checks
    outcome = F.when(~F.coalesce(valid, F.lit(False)), "invalid_row")
    outcome = outcome.when(prompt.isNull() | chosen.isNull() | rejected.isNull(), "render_splice_failed")
    outcome = outcome.when(n_prompt > most_prompt, "prompt_too_long").when(longest > most_completion, "completion_too_long").when(n_prompt + longest > most_total, "too_long")
    return outcome.when((strip(chosen) == "") | (strip(rejected) == ""), "empty_completion").otherwise("kept")
