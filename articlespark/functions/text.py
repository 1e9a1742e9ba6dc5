"""String functions: cleaning, datelines, media type, bands, addresses."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .lists import let

# Java's \w and \s are ASCII only; these classes cover what Python's cover.
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
# the same characters one by one
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Media classes in order of precedence, each with its keywords.
MEDIA_KEYWORDS = {
    "video": ["video", "watch", "live", "stream", "youtube", "vimeo", "twitch"],
    "audio": ["audio", "listen", "podcast", "radio"],
    "image": ["image", "photo", "picture", "gif"],
    "infographic": ["infographic"],
    "poll": ["poll"],
    "twitter": ["twitter", "X", "x", "tweet", "retweeted"],
    "facebook": ["facebook", "fb", "like", "share", "comment"],
    "instagram": ["instagram", "ig"],
    "linkedin": ["linkedin", "share"],
}

# State patterns per country, tried in order.
STATE_PATTERNS = [
    r", ([A-Z]{2}) \d{5}, USA",
    r", ([A-Za-z\s]+) \d{4}, Australia",
    r", ([A-Za-z\s]+), UK",
    r", ([A-Za-z\s]+) \d{5}, France",
    r", ([A-Za-z\s]+), Canada",
    r", ([A-Za-z\s]+), New Zealand",
    r", ([A-Za-z\s]+), India",
    r", ([A-Za-z\s]+), Argentina",
]


def default_stopwords(spark: SparkSession) -> list[str]:
    """Spark ML's English list; callers may pass any other list."""
    from pyspark.ml.feature import StopWordsRemover

    return [w.lower() for w in StopWordsRemover.loadDefaultStopWords("english")]


def strip(c: Column) -> Column:
    # a pattern would be tried at every blank of the text
    return F.btrim(c, F.lit(SPACES))


def is_blank(c: Column) -> Column:
    return c.rlike(f"^[{SPACE}]*$")


def first_sentence(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def strip_punct(c: Column) -> Column:
    return F.regexp_replace(c, f"[^{WORD}{SPACE}]", "")


def strip_tags(c: Column) -> Column:
    # [^\n] rather than '.', which in Java also stops at other line terminators
    return F.when(c.contains("<"), F.regexp_replace(c, r"<[^\n]*?>", "")).otherwise(c)


def words(c: Column) -> Column:
    """Whitespace-separated tokens without empty strings."""
    return F.array_remove(F.split(c, f"[{SPACE}]+"), "")


def drop_words(tokens: Column, stopwords: Iterable[str]) -> Column:
    stop = list(stopwords)
    return F.filter(tokens, lambda w: ~w.isin(stop)) if stop else tokens


def replace_words(tokens: Column, words_map: Column) -> Column:
    """Tokens mapped through a map column; words it does not have, and a null map, change nothing."""
    return F.transform(tokens, lambda w: F.coalesce(F.try_element_at(words_map, w), w))


def lemmatize(tokens: Column, lemmas: Mapping[str, str]) -> Column:
    """Tokens mapped through a few given forms, written into the plan. For a dictionary see
    ``operators.textjobs.lemmatize_join``, which takes a table."""
    if not lemmas:
        return tokens
    table = F.create_map(*[F.lit(x) for pair in lemmas.items() for x in pair])
    known = list(lemmas)
    return F.transform(tokens, lambda w: F.when(w.isin(known), F.try_element_at(table, w)).otherwise(w))


def clean_tokens(c: Column, stopwords: Iterable[str], lemmas: Mapping[str, str] | None = None) -> Column:
    """Tags and punctuation off, lower case, stopwords dropped, lemmas mapped."""
    tokens = drop_words(words(F.lower(strip_punct(strip_tags(c)))), stopwords)
    return lemmatize(tokens, lemmas or {})


def clean_text(c: Column, stopwords: Iterable[str], lemmas: Mapping[str, str] | None = None) -> Column:
    """``clean_tokens`` joined by single spaces; null gives the empty string."""
    return F.coalesce(F.array_join(clean_tokens(c, stopwords, lemmas), " "), F.lit(""))


def cloud_clean(c: Column, stopwords: Iterable[str] = (), remove_stopwords: bool = True,
                remove_punctuation: bool = True) -> Column:
    """Word-cloud text: lower case; optionally ASCII letters only; optionally without stopwords
    and words of at most two characters."""
    out = F.lower(c)
    if remove_punctuation:
        out = F.regexp_replace(out, f"[^a-z{SPACE}]", "")
    tokens = words(out)
    if remove_stopwords:
        tokens = F.filter(drop_words(tokens, stopwords), lambda w: F.length(w) > 2)
    return F.array_join(tokens, " ")


def title_and_text(title: Column, text: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), text)


def lower_no_punct(*cols: Column) -> Column:
    """Lower case without punctuation; several columns are joined by a space."""
    parts = [strip_punct(F.lower(F.coalesce(c, F.lit("")))) for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws(" ", *parts)


def plain_quotes(c: Column) -> Column:
    return F.translate(c, "‘’", "''")


def contraction_tokens(c: Column, stopwords: Iterable[str]) -> Column:
    """Lower-case tokens that are wholly ASCII letters with at most one inner apostrophe."""
    tokens = F.regexp_extract_all(F.lower(plain_quotes(c)), F.lit(f"([{WORD}]+(?:'[{WORD}]+)*+)"), 1)
    plain = F.filter(tokens, lambda w: w.rlike(r"^[a-z]+('[a-z]+)?$"))
    return drop_words(plain, stopwords)


def alpha_lemma_tokens(c: Column, stopwords: Iterable[str], lemmas: Mapping[str, str]) -> Column:
    """Lemmas of the purely alphabetic non-stopwords."""
    tokens = F.regexp_extract_all(c, F.lit(f"([{WORD}]+)"), 1)
    stop = list(stopwords)
    kept = F.filter(tokens, lambda w: w.rlike(r"^\p{L}+$") & ~F.lower(w).isin(stop or [""]))
    return lemmatize(F.transform(kept, F.lower), lemmas)


def word_tokens(c: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"([{WORD}]{{2,}})"), 1)


def dateline(text: Column) -> tuple[Column, Column]:
    """``(source, rest)``: a leading ``PLACE (Agency) -`` and the text without it."""
    source = strip(F.regexp_extract(text, rf"^[A-Za-z{SPACE},/.]+ \([A-Za-z]+\) -", 0))
    rest = F.when(source != "", strip(F.replace(text, source, F.lit("")))).otherwise(text)
    return source, rest


def source_parts(source: Column) -> tuple[Column, Column]:
    """``(location, name)``: the part outside brackets and the first bracketed part."""
    location = strip(F.regexp_replace(source, r"\([^\n]*?\)| -", ""))
    name = strip(F.regexp_extract(source, r"\(([^\n]*?)\)", 1))
    return location, name


def source_parts_strict(source: Column) -> tuple[Column, Column]:
    """Variant whose two patterns are both anchored at the start, so a usual dateline gives
    two empty strings."""
    place = F.regexp_extract(source, rf"^[A-Za-z{SPACE},/.&\-0-9]+", 0)
    name = F.regexp_extract(source, rf"^\([A-Za-z0-9/\-{SPACE}]+\)", 0)
    both = (place != "") & (name != "")
    inner = F.regexp_replace(strip(name), r"^\(|\)$", "")
    empty = F.lit("")
    return F.when(both, strip(place)).otherwise(empty), F.when(both, inner).otherwise(empty)


def split_places(location: Column) -> Column:
    """``'A/B'`` to ``['A', 'B']``; null to ``['UNKNOWN']``."""
    parts = F.transform(F.split(location, "/"), strip)
    return F.coalesce(parts, F.array(F.lit("UNKNOWN")))


def media_type(c: Column, keywords: Mapping[str, list[str]] = MEDIA_KEYWORDS) -> Column:
    """First class with a keyword occurring anywhere in the lower-cased text, else ``text``."""
    def first_hit(text: Column) -> Column:
        out = None
        for name, keys in keywords.items():
            hit = text.contains(keys[0])
            for key in keys[1:]:
                hit = hit | text.contains(key)
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return out.otherwise("text")

    return let(F.lower(c), first_hit)


def combined_media_type(title_type: Column, article_type: Column) -> Column:
    return F.when(title_type != "text", title_type).otherwise(article_type)


def polarity_band(p: Column) -> Column:
    return F.when(p > 0, "positive").when(p < 0, "negative").otherwise("neutral")


def subjectivity_band(s: Column) -> Column:
    # 'higly' is how the label is spelled in the data
    return (F.when(s > 0.8, "highly subjective").when(s > 0.6, "subjective").when(s > 0.4, "neutral")
            .when(s > 0.2, "objective").otherwise("higly objective"))


def sentiment_label(p: Column, s: Column) -> Column:
    return F.concat_ws(" ", polarity_band(p), subjectivity_band(s))


def address_parts(address: Column) -> tuple[Column, Column, Column]:
    """``(continent, country, state)``: third last, last and second last comma part."""
    parts = F.split(F.when(address != "", address), ", ")
    return tuple(F.try_element_at(parts, F.lit(i)) for i in (-3, -1, -2))


def title_case(c: Column) -> Column:
    """Capital after every non-letter (``initcap`` only looks at spaces)."""
    pieces = F.split(F.lower(c), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(pieces, F.initcap), "")


def address_state(address: Column, state: Column | None = None) -> Column:
    """Given state, else the first pattern found in the address; in title case."""
    found = [F.nullif(F.regexp_extract(address, p, 1), F.lit("")) for p in STATE_PATTERNS]
    guess = strip(F.coalesce(*found))
    return title_case(guess if state is None else F.coalesce(state, guess))


def address_country(address: Column, country: Column | None = None) -> Column:
    last = strip(F.element_at(F.split(address, ","), -1))
    return last if country is None else F.coalesce(country, last)


def join_list(text: Column, items: Column) -> Column:
    return F.concat(text, F.lit(" "), F.array_join(items, " "))
