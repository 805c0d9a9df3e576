"""Text normalisation: sentences, tokens, and one pass of array expressions over them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import col

# The e-mail pattern (runs before lower-casing) and the characters that split words.
EMAIL = r"([a-z0-9!#$%&'*+\/=?^_`{|}~-]+(?:\.[a-z0-9!#$%&'*+\/=?^_`{|}~-]+)*(@|\sat\s)(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?(\.|\sdot\s))+[a-z0-9](?:[a-z0-9-]*[a-z0-9])?)"
SPLIT = r",|/|-|(?U:\s)|'"

#: What Python's float() reads, once punctuation is gone and before lower-casing.
NUMBER = r"(?i)^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?$|^[+-]?(nan|inf|infinity)$"

# The stop words of this package, frozen so that results do not change with a library.
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being below between both but by can "
    "could did do does doing down during each few for from further had has have having he her here hers herself him himself his how i "
    "if in into is it its itself just me more most my myself no nor not now of off on once only or other our ours ourselves out over own "
    "same she should so some such than that the their theirs them themselves then there these they this those through to too under "
    "until up very was we were what when where which while who whom why will with would you your yours yourself yourselves"
).split()


def sentences(c: Column | str) -> Column:
    """Split after . ! or ? that white space and a capital, digit or quote follow, and at blank lines."""
    return F.split(col(c), r"(?<=[.!?])(?U:\s)+(?=[\p{Lu}\d\"'(])|\n(?U:\s)*\n")


def remove_email(c: Column | str) -> Column:
    """The pattern is tried only where one of its two separators is, as it starts anew at every letter."""
    c = col(c)
    return F.when(F.contains(c, F.lit("@")) | c.rlike(r"\sat\s"), F.regexp_replace(c, EMAIL, "")).otherwise(c)


# The marks that Treebank tokens part from words; a colon only where no digit follows, an opening quote as two backticks.
MARKS = r"([;@#$%&?!*()\[\]{}<>\"«»“”‘„’]|`+|\.{2,}|:(?!\d))"
OPENING = r"(?<=^|[ (\[{<])\""


def marked(c: Column | str) -> Column:
    """The split characters become spaces, and the marks stand apart."""
    spaced = F.regexp_replace(col(c), SPLIT, " ")
    return F.regexp_replace(F.regexp_replace(spaced, OPENING, " `` "), MARKS, r" $1 ")


def word_tokens(c: Column | str) -> Column:
    """Words after the split characters become spaces: Treebank-style, the marks apart from the words they touch, any other sign
    (as in c++) with them. A full stop stays with its word, from which clean_tokens takes all punctuation."""
    return F.filter(F.split(marked(c), r"(?U:\s)+"), lambda t: t != "")


def _apostrophe(t: Column) -> Column:
    return F.when(t == "'s", "").when(t == "'ll", "will").when(t == "n't", "not").otherwise(t)


def clean_tokens(tokens: Column) -> Column:
    """Apostrophes, punctuation, numbers, case, currency, single backticks, URLs; what is empty then goes."""
    bare = F.transform(tokens, lambda t: F.regexp_replace(_apostrophe(t), r"\p{P}", ""))
    kept = F.filter(bare, lambda t: ~t.rlike(NUMBER))
    lowered = F.transform(kept, F.lower)
    return F.filter(lowered, lambda t: (t != "") & ~t.rlike(r"^\p{Sc}|\p{Sc}$") & (t != F.chr(F.lit(96))) & ~t.startswith("www") & ~t.startswith("http"))


def remove_stop_words(tokens: Column, stop_words: list[str] | None = None) -> Column:
    """Duplicates stay."""
    stop = STOP_WORDS if stop_words is None else stop_words
    return F.filter(tokens, lambda t: ~t.isin(*stop)) if stop else tokens


#: What clean_tokens drops, as one pattern over bare lower-case words: nothing, numbers, currency, a single backtick, URLs.
DROPPED = rf"^$|{NUMBER}|^\p{{Sc}}|\p{{Sc}}$|^`$|^www|^http"


def clean_sentences(c: Column | str, remove_stop: bool = True) -> Column:
    """array<array<string>>: the cleaned tokens of each sentence, as clean_tokens gives for word_tokens. Punctuation goes and case is
    lowered a sentence at a time (no apostrophe is left after the split), so that a token costs one pattern."""

    def cleaned(s: Column) -> Column:
        bare = F.lower(F.regexp_replace(marked(remove_email(s)), r"\p{P}+", ""))
        tokens = F.filter(F.split(bare, r"(?U:\s)+"), lambda t: ~t.rlike(DROPPED))
        return remove_stop_words(tokens) if remove_stop else tokens

    return F.transform(sentences(c), cleaned)


def clean_text(c: Column | str, remove_stop: bool = True) -> Column:
    """array<string>: the cleaned tokens of all sentences."""
    return F.flatten(clean_sentences(c, remove_stop))


def ascii_words(c: Column | str, least: int = 1) -> Column:
    """Lower-cased runs of ASCII letters of at least so many characters; the tokenizer that SQL engines share."""
    return F.filter(F.split(F.lower(col(c)), "[^a-z]+"), lambda t: F.length(t) >= least)


def ngrams(tokens: Column, sizes: tuple[int, ...] = (1, 2)) -> Column:
    """Joined by spaces, of each size in turn."""

    def of(size: int, t: Column) -> Column:
        if size == 1:
            return t
        starts = F.when(F.size(t) >= size, F.sequence(F.lit(1), F.size(t) - (size - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.element_at(t, i + k) for k in range(size)]))

    # Bound once, so that the tokens are not computed again for every position.
    return F.element_at(F.transform(F.array(tokens), lambda t: F.concat(*[of(n, t) for n in sizes])), 1)
