"""Column functions on text, sentences and tokens (letters of ASCII, lower case)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Phrases that are taken out of a sentence, and words by which a greeting is told.
STOCK_PHRASES = ("Thank you", "thank you", "thanks", "Thanks", "earnings call", "earnings release", "earnings conference")
APOLOGIES = ("Sorry", "sorry")
GREETINGS = ("good morning", "good afternoon", "good evening")
CEO_TITLES = ("ceo", "chief executive officer")
EARNINGS = ("earnings", "earning")
MERGERS = ("acquisition", "merger", "takeover")
#: Accented Latin letters and what they are without the accent.
ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
MARK = "\x01"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def with_value(value: Column, fn) -> Column:
    """``fn`` of the value, which is worked out once however often ``fn`` uses it."""
    return F.transform(F.array(value), fn)[0]


def joined(parts: Column) -> Column:
    """Text of a list of strings, trimmed; null where nothing is left."""
    return F.nullif(F.trim(F.array_join(parts, " ")), F.lit(""))


def sentences(text: Column) -> Column:
    """Sentences by their end marks, which they keep."""
    return F.split(F.regexp_replace(text, r"([.!?])\s+", "$1" + MARK), MARK)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case: the same in any engine and language."""
    return F.translate(text, UPPER, UPPER.lower())


def tokens(text: Column) -> Column:
    """Runs of ASCII letters; they alone are put in lower case, which needs no table of letters then."""
    return F.transform(F.filter(F.split(text, "[^A-Za-z]+"), lambda w: w != ""), F.lower)


def tokens_and_ends(text: Column) -> Column:
    """The :func:`tokens` of all the :func:`sentences` in one array, found in one pass, with an empty string where a sentence ends."""
    return F.transform(F.regexp_extract_all(text, F.lit(rf"([A-Za-z]+)|[.!?](?=\s)|{MARK}"), 1), F.lower)


def clean(text: Column, contractions: dict[str, str]) -> Column:
    """Contractions written out, double quotes and single letters dropped, other characters a space, lower case."""
    bare = F.replace(expand_contractions(text, contractions), F.lit('"'), F.lit(""))
    runs = F.filter(F.split(bare, "[^A-Za-z0-9_]+"), lambda w: (F.length(w) != 1) | ~F.regexp_like(w, F.lit("^[A-Za-z]$")))
    return F.lower(F.trim(F.regexp_replace(F.array_join(runs, " "), "[^A-Za-z]+", " ")))


def content_tokens(text: Column, stop_words, lemmas: dict[str, str] | None = None) -> Column:
    """Tokens in their base form (by a table; a word without an entry is its own) that are no stop words."""
    base = F.transform(tokens(text), lambda w: lemma(w, lemmas)) if lemmas else tokens(text)
    return F.filter(base, lambda w: ~w.isin(*stop_words))


def lemma(word: Column, lemmas: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in sorted(lemmas.items()) for x in kv])
    return F.coalesce(F.try_element_at(table, word), word)


def raw_tokens(text: Column, stop_words, lemmas: dict[str, str]) -> Column:
    """Words between spaces in their base form, marks and digits kept, without stop words."""
    words = F.filter(F.split(lower_ascii(text), " +"), lambda w: w != "")
    return F.filter(F.transform(words, lambda w: lemma(w, lemmas)), lambda w: ~w.isin(*stop_words))


def tagged(text: Column) -> Column:
    """Array of (word, tag): a stand-in for a tagger, by form alone (NUM, PUNCT, PROPN for capitals, else WORD)."""
    words = F.regexp_extract_all(text, F.lit("[A-Za-z]+|[0-9]+|[.,;:!?]"), F.lit(0))

    def tag(w: Column) -> Column:
        return F.when(F.regexp_like(w, F.lit("^[0-9]")), "NUM").when(F.regexp_like(w, F.lit("^[.,;:!?]")), "PUNCT").when(F.regexp_like(w, F.lit("^[A-Z]")), "PROPN").otherwise("WORD")

    return F.transform(words, lambda w: F.struct(w.alias("word"), tag(w).alias("tag")))


def words_by_tag(parts: Column, drop, stop_words) -> Column:
    """Lower-case words of :func:`tagged` whose tag is not among ``drop`` and that are no stop words."""
    kept = F.filter(parts, lambda p: ~p["tag"].isin(*drop) & ~lower_ascii(p["word"]).isin(*stop_words))
    return F.transform(kept, lambda p: lower_ascii(p["word"]))


def match_terms(parts: Column, stop_words, lemmas: dict[str, str]) -> Column:
    """Words of a term: proper nouns in lower case as they are, others in base form without stop words, marks and numbers."""
    named = lambda p: p["tag"] == "PROPN"
    kept = F.filter(parts, lambda p: named(p) | ~p["tag"].isin("NUM", "PUNCT") & ~lower_ascii(p["word"]).isin(*stop_words))
    return F.transform(kept, lambda p: F.when(named(p), lower_ascii(p["word"])).otherwise(lemma(lower_ascii(p["word"]), lemmas)))


def preprocessed(text: Column, contractions: dict[str, str], stop_words, lemmas: dict[str, str]) -> Column:
    """(cleaned, words, count); (null, [], 0) for a blank text."""
    blank = F.coalesce(F.trim(text) == "", F.lit(True))
    none = F.array().cast("array<string>")

    def of(cleaned: Column, words: Column) -> Column:
        return F.struct(cleaned.alias("cleaned"), words.alias("words"), F.size(words).alias("count"))

    return with_value(F.when(~blank, clean(text, contractions)), lambda c: with_value(F.coalesce(content_tokens(c, stop_words, lemmas), none), lambda w: of(c, w)))


def preprocessed_list(sents: Column, stop_words, lemmas: dict[str, str], min_words: int = 5) -> Column:
    """Array of (cleaned, words, count), in order; ("", [], 0) for a sentence that is rejected."""

    kept = F.transform(sents, lambda s: F.coalesce(kept_sentence(s, min_words), F.lit("")))
    both = F.transform(kept, lambda k: F.struct(k.alias("cleaned"), content_tokens(k, stop_words, lemmas).alias("words")))
    return F.transform(both, lambda z: F.struct(z["cleaned"], z["words"], F.size(z["words"]).alias("count")))


def expand_contractions(text: Column, table: dict[str, str]) -> Column:
    """Words (between spaces) that are contractions, written out."""
    table_of = F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv])
    return F.array_join(F.transform(F.split(F.replace(text, F.lit("’"), F.lit("'")), " "), lambda w: F.coalesce(F.try_element_at(table_of, w), w)), " ")


def ngrams(words: Column, n: int) -> Column:
    """Runs of n words, joined by a space."""
    grams = words
    for k in range(2, n + 1):
        grams = F.zip_with(grams, F.slice(words, F.lit(k), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(grams, lambda g: g.isNotNull())


def without_phrases(sentence: Column, phrases: tuple[str, ...] = STOCK_PHRASES) -> Column:
    for p in phrases:
        sentence = F.replace(sentence, F.lit(p), F.lit(""))
    return sentence


def is_one_of(word: Column, words) -> Column:
    return word.isin(*words).cast("int")


def kept_sentence(sentence: Column, min_words: int = 5, rejects: tuple[str, ...] = GREETINGS, legacy: bool = False) -> Column:
    """The sentence without stock phrases; null if it is a greeting or too short.

    ``legacy``: empty strings between two spaces count as words, and the ends are not trimmed.
    """
    bare = without_phrases(sentence)
    if not legacy:
        bare = F.regexp_replace(bare, r"^\s+|\s+$", "")

    def judged(b: Column) -> Column:
        words = F.size(F.split(b, " ")) if legacy else F.size(F.filter(F.split(b, r"\s+"), lambda w: w != ""))
        greets = F.lit(False)
        for g in rejects:
            greets = greets | F.contains(lower_ascii(b), F.lit(g))
        return F.when((words >= min_words) & ~greets, b)

    return with_value(bare, judged)


def kept_sentences(text: Column, min_words: int = 5) -> Column:
    return F.filter(F.transform(sentences(text), lambda s: kept_sentence(s, min_words)), lambda s: s.isNotNull())


def any_contains(text: Column, words: tuple[str, ...]) -> Column:
    """1 if the text holds one of the words in any case, else 0 (a null text: 0)."""
    found = F.lit(False)
    for w in words:
        found = found | F.contains(F.lower(text), F.lit(w))
    return F.coalesce(found, F.lit(False)).cast("int")


def dollar_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\$[0-9]+"))


def number_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[$]*[0-9]+[.]*[0-9]*"))


def without_accents(text: Column) -> Column:
    return F.translate(text, ACCENTED, PLAIN)


def is_operator_turn(text: Column) -> Column:
    """1 for turns under three words or with the word operator."""
    words = F.split(F.lower(text), " ")
    return ((F.size(words) < 3) | F.array_contains(words, "operator") | F.array_contains(words, "operator,")).cast("int")


def one_if_all_equal(parts: Column) -> Column:
    return F.when(F.size(F.array_distinct(parts)) == 1, F.slice(parts, 1, 1)).otherwise(parts)


def _labelled(sents: Column, labels: Column, keep) -> Column:
    """(sentence, label) side by side, those that ``keep`` takes; arrays are walked together, never looked up by place."""
    return F.filter(F.zip_with(sents, labels, lambda s, x: F.struct(s.alias("s"), x.alias("x"))), keep)


def no_questions(sents: Column, labels: Column) -> tuple[Column, Column]:
    """Sentences that don't end with a question mark, and the labels beside them."""
    kept = _labelled(sents, labels, lambda z: ~F.endswith(z["s"], F.lit("?")))
    return F.transform(kept, lambda z: z["s"]), F.transform(kept, lambda z: z["x"])


def positive_statements(sents: Column, labels: Column) -> Column:
    kept = _labelled(sents, labels, lambda z: ~F.endswith(z["s"], F.lit("?")) & (z["x"] == 1))
    return F.transform(kept, lambda z: z["s"])


def topic_key(name: Column) -> Column:
    return F.upper(F.replace(name, F.lit(" "), F.lit("_")))


def spaced_terms(term: Column) -> Column:
    """Two-part terms with a space for the underscore."""
    return F.when(F.size(F.split(term, "_")) == 2, F.replace(term, F.lit("_"), F.lit(" "))).otherwise(term)


def parse_list(text: Column, kind: str = "string") -> Column:
    """A list written as JSON or with single quotes; an empty list where it can't be read."""
    return F.coalesce(F.from_json(text, f"array<{kind}>"), F.array().cast(f"array<{kind}>"))


def duplicate_percent(parts: Column) -> Column:
    """100 * (all - distinct) / all, 0 for an empty list."""
    n = F.size(parts)
    return F.when(n > 0, (n - F.size(F.array_distinct(parts))) * 100 / n).otherwise(0.0)


def distinct_if_many(parts: Column, threshold: float = 15.0) -> Column:
    return F.when(duplicate_percent(parts) > threshold, F.array_distinct(parts)).otherwise(parts)
