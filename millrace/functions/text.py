"""Text normalisation and extraction as column expressions.

Patterns run with Unicode classes ((?U)), and white space includes U+001C to U+001F, so that word and blank mean what
they mean to a Unicode-aware scanner. Such classes are slow to search for, so a cheap test that is true at least wherever
the pattern matches comes first where there is one. Nothing here leaves the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.lexicons import RATE_REWRITES, UNIT_REWRITES, WRONG_CONVERSION

#: All white space, as a pattern and as characters.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Without white space, of any script, at both ends."""
    return F.btrim(text, F.lit(SPACES))


def squeeze(text: Column) -> Column:
    """Runs of white space as one blank."""
    return F.regexp_replace(text, rf"{SPACE}+", " ")


def norm(text: Column) -> Column:
    """The comparison form of a text: stripped, lower-cased, blanks squeezed; null counts as empty."""
    return squeeze(F.lower(strip(F.coalesce(text, F.lit("")))))


def row_key(instruction: Column, response: Column) -> Column:
    """A content key: SHA-1 over the normalised instruction (2,000 characters) and response (4,000)."""
    parts = F.struct(F.substring(norm(instruction), 1, 2000).alias("instruction"), F.substring(norm(response), 1, 4000).alias("response"))
    return F.sha1(F.to_json(parts))


def word_count(text: Column) -> Column:
    """White-space separated words; 0 for an empty text."""
    bare = strip(F.coalesce(text, F.lit("")))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, rf"{SPACE}+")))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once, however often use mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rewrite(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda t, rule: F.regexp_replace(t, f"(?iU){rule[0]}", rule[1]), rules, text)


#: What a text without digits must have for a rewrite to match: spp, or a unit or nutrient as a word, a gap, and ha; in
#: either case, with the long s and the Kelvin sign, which are s and k to a search without case.
_WORDY = r"[sS\u017f][pP][pP]|(?:^|[^\p{L}\p{Nd}_])(?:[lLgGtTnNpPkK\u212a]|[kK\u212a][gG]|[mM][lL]|[pP]2[oO]5|[kK\u212a]2[oO])[^\p{L}\p{Nd}_]+[hH][aA]"


def _needs_digit(pattern: str) -> bool:
    return bool(re.search(r"[0-9]|\\d", re.sub(r"\{[^}]*\}|p2o5|k2o", "", pattern)))


def normalize_units(text: Column) -> Column:
    """Unit spellings in one form; the order of the rewrites matters.

    All but three rewrites need a digit, and those need a word that few texts have, so that most texts cost two searches.
    """
    wordy = tuple(rule for rule in UNIT_REWRITES if not _needs_digit(rule[0]))

    def rewritten(plain: Column) -> Column:
        without_digit = F.when(plain.rlike(_WORDY), _rewrite(plain, wordy)).otherwise(plain)
        return F.when(plain.rlike(r"\p{Nd}"), _rewrite(plain, UNIT_REWRITES)).otherwise(without_digit)

    return let(F.translate(F.coalesce(text, F.lit("")), "‑–", "--"), rewritten)


def strip_wrong_conversions(text: Column) -> Column:
    """Without a kg/ha aside behind a kg/acre rate."""
    return strip(F.regexp_replace(F.regexp_replace(text, f"(?iU){WRONG_CONVERSION}", "$1"), r"[ \t]+", " "))


def normalize_text(text: Column) -> Column:
    """Units, rates and blanks in one form, with line breaks kept."""
    units = normalize_units(strip(F.coalesce(text, F.lit(""))))
    lines = F.regexp_replace(F.regexp_replace(units, r"[ \t]+", " "), r" ?\n ?", "\n")
    return let(lines, lambda t: strip(F.when(F.contains(t, F.lit("/")), _rewrite(t, RATE_REWRITES)).otherwise(t)))


def canonical_number(number: Column) -> Column:
    """Without leading zeros, and without trailing ones after a point."""
    has_point = F.contains(number, F.lit("."))
    cut = F.when(has_point, F.regexp_replace(number, r"\.?0*$", "")).otherwise(number)
    whole = F.regexp_replace(cut, r"^0+(?=[0-9])", "")
    return F.when(whole.isin("", "."), "0").otherwise(whole)


def extract_numbers(text: Column) -> Column:
    """The distinct canonical numbers of a text."""

    def found(plain: Column) -> Column:
        # commas with three digits behind them, inside a group that begins with one to three digits
        joined = F.regexp_replace(normalize_units(plain), r"(?<=(?<![\p{L}\p{N}_])\d{1,3}(?:,\d{3}){0,6}),(?=\d{3}(?:,\d{3})*(?![\p{L}\p{N}_]))", "")
        points = F.regexp_replace(joined, r"(?U)\b(\d+),(\d+)\b", "$1.$2")
        numbers = F.array_distinct(F.transform(F.regexp_extract_all(points, F.lit(r"(?U)\d+(?:\.\d+)?"), F.lit(0)), canonical_number))
        return F.when(plain.rlike(r"\p{Nd}"), numbers).otherwise(F.array().cast("array<string>"))

    return let(F.coalesce(text, F.lit("")), found)


def clip(text: Column, limit: int = 160) -> Column:
    """A one-line preview."""
    line = strip(F.regexp_replace(text, "\n", " "))
    return F.when(F.length(line) <= limit, line).otherwise(F.concat(F.substring(line, 1, limit - 3), F.lit("...")))


def size_bucket(count: Column) -> Column:
    """The size class of a data set."""
    return F.when(count < 1_000, "n<1K").when(count < 10_000, "1K<n<10K").when(count < 100_000, "10K<n<100K").otherwise("100K<n<1M")


def token_budget(user: Column, assistant: Column, retry: Column, *, floor: int = 4096, ceiling: int = 16384) -> Column:
    """Answer tokens to allow: a third of the characters above the floor, doubled with every retry, below the ceiling."""
    base = F.greatest(F.lit(floor), F.lit(floor) + F.floor((F.length(user) + F.length(assistant)) / 3) + 64)
    return F.least(F.lit(ceiling).cast("long"), base * F.pow(F.lit(2.0), retry).cast("long")).cast("long")


def embedded_json(raw: Column, schema: str) -> Column:
    """The object in a model's answer: fences dropped, parsed; else what is between the first and last brace."""
    bare = strip(F.regexp_replace(strip(raw), r"^```[a-zA-Z]*\s*|\s*```$", ""))
    inner = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    return F.coalesce(F.from_json(F.when(bare.startswith("{"), bare), schema), F.from_json(inner, schema))


def feedback(raw: Column, error: Column, limit: int = 1500) -> Column:
    """What is said of a rejected answer."""
    return F.concat_ws("\n", F.concat(F.lit("Rejected: "), error), F.lit("Previous answer:"), F.substring(raw, 1, limit))


def request_body(user: Column, system: str, model: str, max_tokens: Column) -> Column:
    """A chat request as JSON."""
    turns = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))
    return F.to_json(F.struct(F.lit(model).alias("model"), turns.alias("messages"), max_tokens.alias("max_completion_tokens")))


def gib(size: Column) -> Column:
    """Bytes as GiB with two places; a dash for none."""
    return F.when(F.coalesce(size, F.lit(0)) == 0, "-").otherwise(F.format_string("%.2f", size / F.lit(float(1 << 30))))


def weight_family(name: Column) -> Column:
    """`blk.<n>.<family>.weight` to its family; null for other names."""
    parts = F.split(name, r"\.")
    fits = name.startswith("blk.") & name.endswith(".weight") & (F.size(parts) >= 4)
    return F.when(fits, F.array_join(F.slice(parts, 3, F.size(parts) - 3), "."))


def base_type(name: Column) -> Column:
    """A quantisation name without its size suffix, upper-cased: q4_k_m to Q4_K."""
    return F.regexp_replace(F.upper(name), r"_(S|M|L|XL)$", "")


def adapter_key(name: Column) -> Column:
    """A weight's name without wrapper prefixes and the adapter's own name."""
    return F.regexp_replace(F.regexp_replace(name, r"^(?:base_model\.model\.)+", ""), r"\.default(?=\.|$)", "")


def public_version(version: Column) -> Column:
    """A version without its local suffix."""
    return F.substring_index(version, "+", 1)


def keep_start(ids: Column, limit: int) -> Column:
    """The first ids."""
    return F.slice(ids, 1, limit)


def keep_end_mark(ids: Column, end: Column, limit: int) -> Column:
    """The ids cut so that they fit with their end mark, which is put back."""
    return F.when(F.size(ids) <= limit, ids).otherwise(F.concat(F.slice(ids, 1, F.greatest(F.lit(0), F.lit(limit) - F.size(end))), end))


def single_start(ids: Column, start: int) -> Column:
    """Without the first id where the first two are the start id."""
    doubled = (F.get(ids, F.lit(0)) == start) & (F.get(ids, F.lit(1)) == start)
    return F.when(F.coalesce(doubled, F.lit(False)), F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0)))).otherwise(ids)


def contains_run(ids: Column, needle: Column) -> Column:
    """Whether needle occurs in ids in one piece."""
    places = F.sequence(F.lit(1), F.greatest(F.size(ids) - F.size(needle) + 1, F.lit(1)))
    return (F.size(needle) <= F.size(ids)) & F.exists(places, lambda p: F.slice(ids, p, F.size(needle)) == needle)


def same_prefix(a: Column, b: Column) -> Column:
    """Whether two lists agree as far as the shorter one goes."""
    n = F.least(F.size(a), F.size(b))
    return F.slice(a, 1, n) == F.slice(b, 1, n)


def warmup_steps(steps_per_epoch: Column, epochs: Column, ratio: Column) -> Column:
    """At least one, and the ratio's part of all steps."""
    total = F.greatest(F.lit(1), F.floor(steps_per_epoch * epochs))
    return F.greatest(F.lit(1), F.floor(total * ratio)).cast("long")


def too_many_tokens(n_ids: Column, n_chars: Column) -> Column:
    """Whether there are more than half as many ids as characters, and 32."""
    return n_ids * 2 > n_chars + 64
