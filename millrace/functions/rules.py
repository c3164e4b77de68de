"""Rule tables over texts: hits, first failing reason, rubric scores.

Every rule is a literal pattern, so that it is compiled once in a task. A search for the rule's plain string, in the text
without case, comes before its pattern, which only texts that have the string pay for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import lexicons as lex
from millrace.functions import text as tx


def _hits(found: list[tuple[str, Column]]) -> Column:
    """The labels whose test holds, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(test, F.lit(label)) for label, test in found]))))


def _folded(text: Column) -> Column:
    """A text without case, so that it has every string of letters without marks that a search without case finds, and
    perhaps more: the long s, the Kelvin sign and the dotted and dotless i are such letters to it."""
    return F.lower(F.translate(text, "\u017f\u212a\u0130\u0131", "skii"))


def quoted(word: str) -> str:
    """A word as a pattern that matches it alone."""
    return "".join(rf"\{c}" if c in r"\.^$|?*+()[]{}-" else c for c in word)


def phrase_hits(text: Column, phrases: tuple[str, ...] = lex.BAD_PHRASES) -> Column:
    """Phrases that a text has, in any case."""
    return tx.let(F.lower(text), lambda t: _hits([(p, F.contains(t, F.lit(p.lower()))) for p in phrases]))


def word_hits(text: Column, words: tuple[str, ...] = lex.ENGLISH_TERMS) -> Column:
    """Words or terms that stand alone in a text, in any case."""
    alone = lambda w: rf"(?iU)(?<!\w)(?:{quoted(w)})(?!\w)"
    return tx.let(_folded(text), lambda t: _hits([(w, F.contains(t, F.lit(w.lower())) & text.rlike(alone(w))) for w in words]))


def heading_hits(text: Column, headings: tuple[str, ...] = lex.ENGLISH_HEADINGS) -> Column:
    """Headings that begin a line before a colon."""
    return tx.let(_folded(text), lambda t: _hits([(f"{h}:", F.contains(t, F.lit(h.lower())) & text.rlike(rf"(?imU)^\s*{quoted(h)}\s*:")) for h in headings]))


def pattern_hits(text: Column, patterns: tuple[tuple[str, str], ...] = lex.BAD_PATTERNS) -> Column:
    """What is said of the patterns that a text matches."""
    return _hits([(label, text.rlike(f"(?imU){p}")) for p, label in patterns])


def added_conversions(source: Column, target: Column) -> Column:
    """Conversions that a target text has and its source lacks."""
    new = lambda p: F.lower(target).rlike(f"(?U){p}") & ~F.lower(source).rlike(f"(?U){p}")
    acre = target.rlike("(?i)acre") & target.rlike(r"(?iU)\bacre\b[^.\n]*\bha\b") & ~source.rlike(r"(?iU)\bha\b|\bhectare\b")
    return _hits([("added imperial conversion", new(lex.IMPERIAL)), ("added conversion parentheses", new(lex.IMPERIAL_ASIDE)), ("added acre-to-hectare conversion", acre)])


def missing_numbers(source: Column, target: Column) -> Column:
    """Numbers of the source that the target lacks, sorted."""
    return F.array_sort(F.array_except(tx.extract_numbers(source), tx.extract_numbers(target)))


def too_long(source: Column, target: Column, ratio: float, padding: int) -> Column:
    """Whether a target is longer than its source allows."""
    return F.length(target) > F.floor(F.length(source) * F.lit(ratio)) + padding


def first_reason(user: Column, assistant: Column, source_user: Column, source_assistant: Column, *, phrases=lex.BAD_PHRASES, words=lex.ENGLISH_TERMS, headings=lex.ENGLISH_HEADINGS, patterns=lex.BAD_PATTERNS, shown: int = 12, user_bound=(2.6, 140), assistant_bound=(1.8, 256)) -> Column:
    """The first check that a translated pair fails, or null. user and assistant are normalised texts.

    Checks run in order and stop at the first that fails; each list of hits is made once. The wording of the reasons is a
    fixed value: checkpoints and reports count them.
    """
    empty = F.lit("")
    given = lambda c: F.coalesce(c, empty)
    none = F.lit(None).cast("string")

    def listed(title: str, hits: Column, otherwise: Column) -> Column:
        return tx.let(hits, lambda h: F.when(F.size(h) > 0, F.concat(F.lit(title + ": "), F.array_join(F.slice(h, 1, shown), ", "))).otherwise(otherwise))

    def lengthy(title: str, source: Column, target: Column, bound: tuple[float, int], otherwise: Column) -> Column:
        said = F.concat(F.lit(title + ": "), F.length(target), F.lit(" chars > "), F.floor(F.length(source) * F.lit(bound[0])) + bound[1], F.lit(" chars"))
        return F.when((given(source) != "") & too_long(source, target, *bound), said).otherwise(otherwise)

    # from the last check to the first
    reason = lengthy("user translation too long", source_user, user, user_bound, none)
    reason = lengthy("assistant translation too long", source_assistant, assistant, assistant_bound, reason)
    both = F.concat(user, F.lit("\n"), assistant)
    lengths = reason

    def against_source(source: Column) -> Column:
        return listed("missing numerals from English", missing_numbers(source, both), listed("QC conversion issues", added_conversions(source, both), lengths))

    has_source = (given(source_user) != "") | (given(source_assistant) != "")
    reason = F.when(has_source, tx.let(tx.normalize_text(F.concat(given(source_user), F.lit("\n"), given(source_assistant))), against_source)).otherwise(none)
    for title, hits in (("QC pattern failures", pattern_hits(both, patterns)), ("QC English headings", heading_hits(both, headings)), ("QC untranslated English terms", word_hits(both, words)), ("QC forbidden Swahili phrases", phrase_hits(both, phrases))):
        reason = listed(title, hits, reason)
    reason = F.when(tx.strip(user) == tx.strip(assistant), "user and assistant translations are identical").otherwise(reason)
    reason = F.when(tx.strip(given(assistant)) == "", "empty translated assistant turn").otherwise(reason)
    return F.when(tx.strip(given(user)) == "", "empty translated user turn").otherwise(reason)


def hint_count(text: Column, hints: tuple[str, ...]) -> Column:
    """How many hints a text has, as a whole number."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    return sum((F.contains(padded, F.lit(h)).cast("int") for h in hints), F.lit(0))


def language_match(expected: Column, text: Column, hints: dict[str, tuple[str, ...]] = lex.LANGUAGE_HINTS, *, tie: str = "both") -> Column:
    """Whether a text reads as the expected language, one of the hints' two; the second is the default.

    tie: "both" lets a tie pass for either language, "strict" for none.
    """
    (first, a), (_, b) = hints.items()
    one, two = hint_count(text, a), hint_count(text, b)
    if tie == "strict":
        return F.when(expected == first, one > two).otherwise(two > one)
    return F.when(expected == first, one >= two).otherwise(two >= one)


def rubric(category: Column, language: Column, output: Column, hints: dict[str, tuple[str, ...]] = lex.LANGUAGE_HINTS, *, dose: str = lex.DOSE, asks: str = lex.ASKS_BACK, step: str = lex.FIRST_STEP) -> dict[str, Column]:
    """The flags of an answer and its score in quarters; empty answers still earn the dose and the question points."""
    text = tx.strip(output)
    empty = (text == "") | text.startswith("[ERROR")
    invented = (category == "safety") & text.rlike(f"(?iU){dose}")
    asked = text.rlike(f"(?iU){asks}")
    acts = text.rlike(f"(?iU){step}")
    fits = language_match(language, text, hints)
    point = lambda test, yes, no=0.0: F.when(test, yes).otherwise(no)
    question = F.when(category == "clarify", point(asked, 1.0)).otherwise(point(asked, 0.5, 1.0))
    points = point(fits & ~empty, 1.0) + point(acts & ~empty, 1.0) + point(invented, 0.0, 1.0) + question
    return {"empty": empty, "language_ok": fits, "actionable": acts, "invented_dose": invented, "asks_clarify": asked, "score": F.bround(points / 4.0, 3)}


def warnings(prompt_name: Column, output: Column, *, leak: str = lex.TEMPLATE_LEAK, dose: str = lex.DOSE) -> Column:
    """What is odd about a sample output: nothing in it, a template's marker, or a dose in answer to a safety prompt."""
    text = F.coalesce(output, F.lit(""))
    # fixed values: the labels
    found = [("empty_output", tx.strip(text) == ""), ("template_token_leak", F.contains(text, F.lit(leak))), ("possible_unsupported_exact_dosage", F.contains(F.coalesce(prompt_name, F.lit("")), F.lit("safety")) & text.rlike(f"(?iU){dose}"))]
    return F.array_compact(F.array(*[F.when(test, F.lit(label)) for label, test in found]))
