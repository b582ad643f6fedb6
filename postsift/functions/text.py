"""Text normalisation and tokens: functions from Column to Column.

Everything here is built from Spark's own expressions, so a projection that
uses it stays in the JVM, needs no shuffle and runs on streams as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postsift.functions.tables import CONTRACTIONS, DELETE_CLASS, ISOLATE_CLASS, MASKED_WORDS

# Latin letters are by far the most common code points beyond ASCII and are
# always kept. Only texts with something rarer than that meet the long classes.
_RARE = r"[\x{80}-\x{bf}\xd7\xf7\x{180}-\x{10ffff}]"
_DELETE_ASCII = r"[\x00-\x1f\x7f]"
_DELETE_ANY = rf"{_DELETE_ASCII}|(?={_RARE})[{DELETE_CLASS}]"
_ISOLATE_ASCII = r"[!-&(-/:-@\[-`{-~]"
_ISOLATE_ANY = rf"{_ISOLATE_ASCII}|(?={_RARE})(?![‘’])[{ISOLATE_CLASS}]"

# Scripts that are written without blanks between words. The ranges that are
# nearly all of them stand first, since to look up a script takes long.
UNSPACED = r"\x{4e00}-\x{9fef}\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{e01}-\x{e3a}" + (
    r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\x{30fc}"
)
_ANY_UNSPACED = rf"(?=[\x{{e00}}-\x{{10ffff}}])[{UNSPACED}]"

# Found one after the other: a pair of characters, of which the first is taken,
# or both if no third one follows; a lone character; what else a word holds.
_UNIT = rf"(?:[\P{{M}}&&[{UNSPACED}]][\p{{M}}&&[{UNSPACED}]]*+|[\p{{M}}&&[{UNSPACED}]]++)"
_OTHER = rf"[[^\s\x{{e00}}-\x{{10ffff}}][\x{{e00}}-\x{{10ffff}}&&[^{UNSPACED}]]]++"
_PIECE = rf"(?=({_UNIT}{_UNIT}?|{_OTHER}))(?:{_UNIT}(?:{_UNIT}(?!{_UNIT}))?|{_OTHER})"


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _escaped(symbols: str) -> str:
    return "".join("\\" + ch if ch in "\\[]^-&" else ch for ch in symbols)


def lower_case(c: Column | str) -> Column:
    return F.lower(_as_column(c))


def expand_contractions(c: Column | str, table=CONTRACTIONS) -> Column:
    """Replace each ``' key '`` by ``' value '``; both spaces must be there.

    Which keys a text may hold is told by its words, so only those few are
    replaced and most texts take no replacement at all. A key that follows
    itself with one shared space is replaced every other time, as a literal
    replacement does. No value may hold a key, so the order does not matter.
    """
    keys = F.split(F.lit("\n".join(k for k, _ in table)), "\n")  # folded to a constant
    values = F.str_to_map(F.lit("\n".join(f"{k}\t{v}" for k, v in table)), F.lit("\n"), F.lit("\t"))

    def expand(text: Column) -> Column:
        present = F.array_intersect(F.split(text, " "), keys)

        def padded(word: Column) -> Column:
            return F.concat(F.lit(" "), word, F.lit(" "))

        return F.aggregate(present, text, lambda acc, k: F.replace(acc, padded(k), padded(values[k])))

    return _let(_as_column(c), expand)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def _by_range(c: Column | str, rare, plain) -> Column:
    """``rare`` for texts with code points that the plain classes lack."""
    return _let(_as_column(c), lambda text: F.when(text.rlike(_RARE), rare(text)).otherwise(plain(text)))


def delete_symbols(c: Column | str, symbols: str | None = None) -> Column:
    """Turn unwanted code points into a space each: by rule, or those given."""
    if symbols is not None:
        return F.translate(_as_column(c), symbols, " " * len(symbols))
    return _by_range(
        c,
        lambda text: F.regexp_replace(text, _DELETE_ANY, " "),
        lambda text: F.regexp_replace(text, _DELETE_ASCII, " "),
    )


def isolate_symbols(c: Column | str, symbols: str | None = None) -> Column:
    """Put a space on both sides of signs: by rule, or of those given."""
    if symbols is not None:
        return F.regexp_replace(_as_column(c), f"[{_escaped(symbols)}]", " $0 ")
    return _by_range(
        c,
        lambda text: F.regexp_replace(text, _ISOLATE_ANY, " $0 "),
        lambda text: F.regexp_replace(text, _ISOLATE_ASCII, " $0 "),
    )


def _space_symbols(c: Column) -> Column:
    """Delete and isolate by rule, with one look at what the text holds."""
    return _by_range(
        c,
        lambda text: F.regexp_replace(F.regexp_replace(text, _DELETE_ANY, " "), _ISOLATE_ANY, " $0 "),
        lambda text: F.regexp_replace(F.regexp_replace(text, _DELETE_ASCII, " "), _ISOLATE_ASCII, " $0 "),
    )


def collapse_spaces(c: Column | str) -> Column:
    """Runs of U+0020 become one; spaces at the edges stay."""
    return F.regexp_replace(_as_column(c), " {2,}", " ")


def strip_edge_quotes(c: Column | str) -> Column:
    """Drop a leading quote, and a trailing quote with the character before it."""

    def quoted(text: Column, at_edge) -> Column:
        return at_edge(text, "'") | at_edge(text, '"')

    def lead(text: Column) -> Column:
        return F.when(quoted(text, Column.startswith), F.substring(text, 2, 2**31 - 1)).otherwise(text)

    def trail(text: Column) -> Column:
        shorter = F.substring(text, F.lit(1), F.length(text) - 2)
        return F.when(quoted(text, Column.endswith), shorter).otherwise(text)

    return _let(_let(_as_column(c), lead), trail)


def blank_backslashes(c: Column | str) -> Column:
    """Backslashes and left-over newlines to a space each."""
    once = F.replace(_as_column(c), F.lit("\\"), F.lit(" "))
    return F.replace(once, F.lit("\n"), F.lit(" "))


def demask(c: Column | str, table=MASKED_WORDS) -> Column:
    """Write out masked words (``h*ll``), one replacement after the other."""
    out = _as_column(c)
    for masked, word in table:
        out = F.replace(out, F.lit(masked), F.lit(word))
    return out


def normalize_text(
    c: Column | str,
    demask_first: bool = False,
    contractions=CONTRACTIONS,
    masks=MASKED_WORDS,
    delete: str | None = None,
    isolate: str | None = None,
) -> Column:
    """All steps of normalisation, in order.

    Masked words stay masked by default: their ``*`` has been set apart by
    the time they could be written out. ``demask_first`` does it up front.
    """
    text = lower_case(c)
    if demask_first:
        text = demask(text, masks)
    text = expand_contractions(text, contractions)
    if delete is None and isolate is None:
        text = _space_symbols(text)
    else:
        text = isolate_symbols(delete_symbols(text, delete), isolate)
    text = collapse_spaces(text)
    text = strip_edge_quotes(text)
    return blank_backslashes(text)


def segmented(text: Column) -> Column:
    """The words of a text, those of scripts that put no blanks between words cut into overlapping pairs of characters.

    A run of such a script within a word becomes the pairs of its neighbours,
    or its one character; a character is taken with the marks on it. What else
    a word holds stays as it is, and words without such scripts are not cut.
    All is found in one run of a pattern over the text.
    """
    return F.regexp_extract_all(text, F.lit(_PIECE), 1)


def tokenize(c: Column | str, min_len: int = 2, normalized: bool = False) -> Column:
    """Lower-case words of at least ``min_len`` characters; texts of scripts without blanks are cut by
    :func:`segmented`.

    ``normalized`` says that the text went through :func:`normalize_text`
    before, which need not be done twice.
    """
    if normalized:
        text, blank = F.lower(_as_column(c)), r"\s+"
    else:
        text, blank = normalize_text(c), " "  # lower-case, no other blanks
    unspaced = _as_column(c).rlike(_ANY_UNSPACED)

    def words(text: Column) -> Column:
        return F.when(unspaced, segmented(text)).otherwise(F.split(text, blank))

    return F.filter(_let(text, words), lambda t: F.length(t) >= min_len)


def cap_tokens(tokens: Column | str, max_len: int) -> Column:
    """At most the first ``max_len`` tokens, the feature cap of a model."""
    return F.slice(_as_column(tokens), 1, max_len)
