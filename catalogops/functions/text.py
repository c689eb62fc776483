"""Text predicates and scalars as plain Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# The characters that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Strip every kind of whitespace (SQL ``trim`` removes only spaces)."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    return strip_ws(c) == ""


def folded(c: Column | str) -> Column:
    """The case-insensitive comparison key: stripped and lower-cased."""
    return F.lower(strip_ws(c))


def sql_list(words: Sequence[str]) -> str:
    """The words as SQL string literals, for one parsed expression per list."""
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _any(words: Sequence[str], test: Callable[[Column], Column]) -> Column:
    """Some word passes. A loop over a literal array: plan and generated code
    stay small for any number of words, and a plain byte search beats a regex
    alternation about fourfold."""
    if not words:
        raise ValueError("an empty keyword list matches nothing; drop the rule")
    return F.exists(F.expr(f"array({sql_list(words)})"), test)


def any_substring(c: Column | str, words: Sequence[str]) -> Column:
    """Any word occurs anywhere in the lower-cased text; no word boundary."""
    return let(F.lower(col(c)), lambda t: _any(words, lambda w: F.contains(t, w)))


def word_prefix(c: Column | str, words: Sequence[str]) -> Column:
    """A word starts the text or follows a literal space; open on the right."""
    return any_substring(F.concat(F.lit(" "), col(c)), [" " + w for w in words])


def padded_or_suffix(
    c: Column | str, words: Sequence[str], veto: Sequence[str] = ()
) -> Column:
    """A word stands between spaces, or the text ends with it (no left boundary).

    Texts holding any ``veto`` substring never match.
    """

    def hit(text: Column) -> Column:
        between = any_substring(
            F.concat(F.lit(" "), text, F.lit(" ")), [f" {w} " for w in words]
        )
        found = between | _any(words, lambda w: F.endswith(text, w))
        return found & ~any_substring(text, veto) if veto else found

    return let(folded(c), hit)


MATCHERS = {
    "substring": any_substring,
    "word_prefix": word_prefix,
    "padded_suffix": padded_or_suffix,
}


def numbered(prefix: str, number: Column) -> Column:
    """``prefix_0007``: four digits at least, as ``%04d``."""
    return F.format_string(f"{prefix}_%04d", number)


def bullet_list(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda m: F.concat(F.lit("- "), m)), "\n")
