"""Lexicon scores of token arrays: polarity with negation, word-class ratios, fog index."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ngrams, tokens

#: Small word lists over the tokens of the synthetic corpus, in place of licensed lexicons.
POSITIVE = ("the", "with", "for")
NEGATIVE = ("was", "that", "by")
NEGATION = ("is", "at", "not", "no", "never")
LITIGIOUS, COMPLEX, UNCERTAIN = ("of", "on"), ("this", "are", "from"), ("it", "be", "as")
#: Syllables of dictionary words, for the fog index.
SYLLABLES = {"this": 1, "are": 1, "from": 1, "tion": 1, "anand": 2, "ering": 3, "tioned": 3, "ereding": 4, "ation": 3, "andation": 4}
LOOK_BACK = 3


def word_set(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def count_in(tokens: Column, words) -> Column:
    return F.size(F.filter(tokens, lambda t: t.isin(*words)))


def negated(tokens: Column, i: Column, negation=NEGATION) -> Column:
    """Whether one of the three tokens before place i is a negation."""
    start = F.greatest(i - LOOK_BACK, F.lit(0))
    return F.arrays_overlap(F.slice(tokens, start + 1, F.least(i, F.lit(LOOK_BACK))), word_set(negation))


def polarity(tokens: Column, positive=POSITIVE, negative=NEGATIVE, negation=NEGATION) -> dict[str, Column]:
    """Counts and scores: a positive word counts as negative if it is negated; a word of both lists counts for both."""
    turned = F.size(F.filter(tokens, lambda t, i: t.isin(*positive) & negated(tokens, i, negation)))
    plus = count_in(tokens, positive) - turned
    minus = count_in(tokens, negative) + turned
    n = F.size(tokens)
    enough = n > 1
    return {
        "n_tokens": n, "n_positive": F.when(enough, plus), "n_negative": F.when(enough, minus),
        "polarity": F.when(enough, (plus - minus) / n), "polarity_legacy": F.when(enough, combined(plus, minus)),
    }


def combined(positive: Column, negative: Column) -> Column:
    """(P - N) / (P + N), 0 where both are 0."""
    return F.coalesce(F.try_divide(positive - negative, positive + negative), F.lit(0.0))


def class_counts(tokens: Column) -> dict[str, Column]:
    return {"n_litigious": count_in(tokens, LITIGIOUS), "n_complex": count_in(tokens, COMPLEX), "n_uncertain": count_in(tokens, UNCERTAIN)}


def syllables(word: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in sorted(SYLLABLES.items()) for x in kv])
    return F.try_element_at(table, word)


def is_complex(word: Column) -> Column:
    """Over two syllables, of the root where the word ends in es, ing or ed and the root is known; else of the word."""
    root = (
        F.when(F.endswith(word, F.lit("es")), syllables(F.left(word, F.length(word) - 2)))
        .when(F.endswith(word, F.lit("ing")), syllables(F.left(word, F.length(word) - 3)))
        .when(F.endswith(word, F.lit("ed")), syllables(F.left(word, F.length(word) - 2)))
    )
    return F.coalesce(root, syllables(word), F.lit(0)) > 2


def fog(n_words: Column, n_sentences: Column, n_complex: Column) -> Column:
    """0.4 * (words a sentence + 100 * complex words a word); null without words."""
    return 0.4 * (F.try_divide(n_words, n_sentences) + F.try_divide(100 * n_complex, n_words))


def fog_of_average(words_a_sentence: Column, n_complex: Column, n_tokens: Column) -> Column:
    """A sentence's fog with its document's mean of words a sentence; null without tokens."""
    return F.when(n_tokens > 0, 0.4 * (words_a_sentence + 100 * (n_complex / n_tokens)))


def fog_of_section(text: Column) -> dict[str, Column]:
    """Fog of a text by its raw words: sentences end at a full stop and a space; null where a token or none is left."""
    words, raw = tokens(text), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    each = F.transform(F.split(text, r"\. "), lambda s: F.regexp_count(s, F.lit(r"[^\x20\x09-\x0D]+")))
    mean = F.aggregate(each, F.lit(0).cast("long"), lambda a, n: a + n) / F.size(each)
    n_complex = F.size(F.filter(words, is_complex))
    enough = F.size(words) > 1
    return {k: F.when(enough, v) for k, v in {"fog": 0.4 * (mean + 100 * (n_complex / raw)), "n_complex": n_complex, "words_a_sentence": mean, "n_words": raw}.items()}


def match_flag(low: Column, words: Column, ones, twos, phrases, suppress=()) -> Column:
    """Whether one of the words, pairs (joined by a space) or phrases stands in a lower-case text, and no suppressing item does."""
    found = F.arrays_overlap(words, word_set(ones)) | F.arrays_overlap(ngrams(words, 2), word_set(twos))
    for p in phrases:
        found = found | F.contains(low, F.lit(p))
    for p in suppress:
        found = found & ~F.contains(low, F.lit(p))
    return found
