"""Text clean-up, tokenising and counting as native column expressions.

Java's ``\\s``, ``\\w`` and ``\\d`` are ASCII only; the classes below spell out the Unicode ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazetick.functions.stem import stem_tokens

WS = r"\s\p{Z}\x{85}\x0b\x1c-\x1f"
WORD = r"\p{L}\p{N}_"

# The 174 English stop words, in their usual order.
STOPWORDS = """
a about above after again against all am an and any are aren't as at be
because been before being below between both but by can't cannot could
couldn't did didn't do does doesn't doing don't down during each few for
from further had hadn't has hasn't have haven't having he he'd he'll he's
her here here's hers herself him himself his how how's i i'd i'll i'm i've
if in into is isn't it it's its itself let's me more most mustn't my
myself no nor not of off on once only or other ought our ours ourselves
out over own same shan't she she'd she'll she's should shouldn't so some
such than that that's the their theirs them themselves then there there's
these they they'd they'll they're they've this those through to too under
until up very was wasn't we we'd we'll we're we've were weren't what
what's when when's where where's which while who who's whom why why's
with won't would wouldn't you you'd you'll you're you've your yours
yourself yourselves
""".split()


def _drop(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def remove_urls(text: Column) -> Column:
    return _drop(text, rf"http[^{WS}]+|www\.[^{WS}]+")


def remove_html_entities(text: Column) -> Column:
    """Named entities only; ``&#39;`` stays for the punctuation and number steps."""
    return _drop(text, rf"&[{WORD}]+;")


def remove_punctuation(text: Column) -> Column:
    """The 32 ASCII marks; typographic quotes and dashes stay."""
    return _drop(text, r"\p{Punct}")


def remove_numbers(text: Column) -> Column:
    return _drop(text, r"\p{Nd}+")


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{WS}]+", " "))


def tokenize(text: Column) -> Column:
    """Whitespace split without empty tokens; null in, null out."""
    return F.filter(F.split(text, rf"[{WS}]+"), lambda t: t != "")


def remove_stopwords(tokens: Column, stopwords: list[str] = STOPWORDS) -> Column:
    words = [F.lit(w) for w in stopwords]
    return F.filter(tokens, lambda t: ~t.isin(*words))


def clean_text_basic(text: Column) -> Column:
    """Lower case, no ``http…``, ASCII letters only, single spaces."""
    return _letters_only(_drop(F.lower(text), rf"http[^{WS}]+"))


def clean_text_www(text: Column) -> Column:
    """As :func:`clean_text_basic`, also without ``www…``."""
    return _letters_only(_drop(F.lower(text), rf"http[^{WS}]+|www[^{WS}]+"))


def _letters_only(text: Column) -> Column:
    return collapse_whitespace(_drop(text, rf"[^a-zA-Z{WS}]"))


def clean_and_tokenize(text: Column) -> Column:
    """Tokens for sequence models: URLs go before lower-casing, so ``HTTP://…`` survives as a word."""
    no_urls = _drop(text, rf"http[^{WS}]+|www[^{WS}]+")
    return tokenize(_drop(F.lower(no_urls), rf"[^{WORD}{WS}]"))


def cleaned_words(text: Column, remove_nums: bool = True, stopwords: list[str] = STOPWORDS) -> Column:
    """Everything of :func:`preprocess_text` up to, not including, the stemmer."""
    out = remove_punctuation(remove_html_entities(remove_urls(F.lower(F.coalesce(text, F.lit(""))))))
    if remove_nums:
        out = remove_numbers(out)
    return remove_stopwords(tokenize(out), stopwords)


def preprocess_tokens(text: Column, remove_nums: bool = True, do_stem: bool = True) -> Column:
    words = cleaned_words(text, remove_nums)
    return stem_tokens(words) if do_stem else words


def preprocess_text(text: Column, remove_nums: bool = True, do_stem: bool = True) -> Column:
    """struct(clean_text, tokens); null or empty text gives ``""`` and ``[]``."""
    tokens = preprocess_tokens(text, remove_nums, do_stem)
    return F.struct(F.array_join(tokens, " ").alias("clean_text"), tokens.alias("tokens"))


def embedding_text(title: Column, body: Column) -> Column:
    """Clean title and paragraph in one string, stripped."""
    blank = F.lit("")
    return F.trim(F.concat_ws(" ", F.coalesce(title, blank), F.coalesce(body, blank)))


def concat_title_body(title: Column, body: Column) -> Column:
    """``title. body``; null when either is null."""
    return F.concat(title, F.lit(". "), body)


def char_count(text: Column) -> Column:
    return F.length(text)


def word_count(text: Column) -> Column:
    return F.size(tokenize(text))


def avg_word_length(text: Column) -> Column:
    """Mean word length; null for a text without words."""
    words = tokenize(text)
    letters = F.length(F.array_join(words, ""))
    return F.try_divide(letters.cast("double"), F.size(words).cast("double"))


def uppercase_words(text: Column) -> Column:
    """Words with a cased letter and no lower-case one."""
    shouting = r"^[^\p{IsLowercase}\p{Lt}]*\p{IsUppercase}[^\p{IsLowercase}\p{Lt}]*$"
    return F.size(F.filter(tokenize(text), lambda w: w.rlike(shouting)))


def pad_truncate(ids: Column, length: int = 40, pad: int = 0) -> Column:
    """Right-pad with ``pad`` and cut at ``length``."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(pad), length)), 1, length)


def format_entities(entities: Column) -> Column:
    """``word (LABEL), …``; null gives ``""``."""
    shown = F.transform(entities, lambda e: F.concat(e["word"], F.lit(" ("), e["label"], F.lit(")")))
    return F.coalesce(F.array_join(shown, ", "), F.lit(""))
