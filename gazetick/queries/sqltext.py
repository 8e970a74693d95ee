"""DuckDB spellings of the text rules, for the check statements."""

from gazetick.functions.text import STOPWORDS

WS = r"\s\p{Z}\x{85}\x0b\x1c-\x1f"
WORD = r"\p{L}\p{N}_"


def drop(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def urls(x: str) -> str:
    return drop(x, rf"http[^{WS}]+|www\.[^{WS}]+")


def entities(x: str) -> str:
    return drop(x, f"&[{WORD}]+;")


def punctuation(x: str) -> str:
    return drop(x, "[[:punct:]]")


def numbers(x: str) -> str:
    return drop(x, r"\p{Nd}+")


def collapse(x: str) -> str:
    return f"trim({drop(x, f'[{WS}]+', ' ')})"


def split(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{WS}]+'), lambda t: t <> '')"


def letters(x: str) -> str:
    return collapse(drop(x, f"[^a-zA-Z{WS}]"))


STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOPWORDS) + "]"


def without_stopwords(x: str) -> str:
    return f"list_filter({x}, lambda t: NOT list_contains({STOP}, t))"


def cleaned_words(x: str) -> str:
    return without_stopwords(split(numbers(punctuation(entities(urls(f"lower({x})"))))))


def sequence_tokens(x: str) -> str:
    return split(drop(f"lower({drop(x, f'http[^{WS}]+|www[^{WS}]+')})", f"[^{WORD}{WS}]"))


def terms(x: str, stop: bool = False) -> str:
    words = f"regexp_extract_all(lower({x}), '[{WORD}]{{2,}}')"
    return without_stopwords(words) if stop else words


VOWEL = "[aeiou]|.y"
MEASURED = "[aeiou][^aeiou]|(^y|[^aeiouy])y[^aeiou]"


def stem_steps(source: str, token: str = "token") -> str:
    """Statements ``s1`` … ``stems``: ``source`` must have a column ``token``; adds ``stem``."""
    cut = lambda c, n: f"left({c}, length({c}) - {n})"
    return f"""
    distinct_words AS (SELECT DISTINCT {token} AS token FROM {source}),
    s1 AS (SELECT token, CASE WHEN length(token) <= 2 THEN token
             WHEN token LIKE '%sses' OR token LIKE '%ies' THEN {cut('token', 2)}
             WHEN token LIKE '%s' AND token NOT LIKE '%ss' THEN {cut('token', 1)} ELSE token END AS w
           FROM distinct_words),
    s2 AS (SELECT token, w,
             w LIKE '%eed' AS eed,
             w NOT LIKE '%eed' AND w LIKE '%ed' AND regexp_matches({cut('w', 2)}, '{VOWEL}') AS ed,
             w LIKE '%ing' AND regexp_matches({cut('w', 3)}, '{VOWEL}') AS ing FROM s1),
    s3 AS (SELECT token, (ed OR ing) AS stripped,
             CASE WHEN eed AND regexp_matches({cut('w', 3)}, '{MEASURED}') THEN {cut('w', 1)}
                  WHEN ed THEN {cut('w', 2)} WHEN ing THEN {cut('w', 3)} ELSE w END AS w FROM s2),
    s4 AS (SELECT token, CASE WHEN NOT stripped THEN w
             WHEN w LIKE '%at' OR w LIKE '%bl' OR w LIKE '%iz' THEN w || 'e'
             WHEN length(w) >= 2 AND right(w, 1) = left(right(w, 2), 1) AND right(w, 1) NOT IN ('l', 's', 'z')
               THEN {cut('w', 1)} ELSE w END AS w FROM s3),
    stems AS (SELECT token, CASE WHEN length(token) <= 2 THEN token
             WHEN w LIKE '%y' AND regexp_matches({cut('w', 1)}, '{VOWEL}') THEN {cut('w', 1)} || 'i'
             ELSE w END AS stem FROM s4)"""
