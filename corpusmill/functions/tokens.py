"""Token sequences for masked-language-model batches, as array expressions.

Words stand for subword pieces, and a word's number is a hash into the vocabulary range: a trained
tokenizer is a per-row library and enters through ``operators.batches.map_batches`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.hashing import hashed_number, seeded

# Vocabulary layout, sequence length, masking rates and the ignored label.
PAD, CLS, SEP, MASK = 0, 101, 102, 103
VOCABULARY = 30_522
FIRST_WORD = 1_000
MAX_LENGTH = 64
IGNORED = -100
MASK_PERMILLE = 150
REPLACED_PERMILLE = 800
RANDOM_PERMILLE = 900


def words(text: Column, limit: int) -> Column:
    """The first ``limit`` words; the split stops there.

    Splitting yields one part more than asked for, the unsplit rest, and an empty part in front of
    leading blanks: two more than the limit always hold enough.
    """
    parts = F.slice(F.split(text, r"(?U)\s+", limit + 2), 1, limit + 1)
    return F.slice(F.filter(parts, lambda word: word != ""), 1, limit)


def word_number(word: Column) -> Column:
    return (hashed_number(F.lower(word), 8) % (VOCABULARY - FIRST_WORD) + FIRST_WORD).cast("int")


def token_ids(text: Column, max_length: int = MAX_LENGTH) -> Column:
    """Start mark, at most ``max_length - 2`` word numbers, end mark; never padded."""
    return F.concat(
        F.array(F.lit(CLS)),
        F.transform(words(text, max_length - 2), word_number),
        F.array(F.lit(SEP)),
    )


def _is_word(token: Column) -> Column:
    return token >= FIRST_WORD


def labels(ids: Column, key: Column, seed: int) -> Column:
    """The token number where it was chosen as a target, the ignored label elsewhere."""
    return F.transform(
        ids,
        lambda token, at: F.when(
            _is_word(token) & (seeded(seed, key, at) % 1000 < MASK_PERMILLE), token
        ).otherwise(F.lit(IGNORED)),
    )


def masked_ids(ids: Column, targets: Column, key: Column, seed: int) -> Column:
    """Targets become the mask (80 %), a random word (10 %) or stay (10 %)."""

    def replace(token: Column, at: Column) -> Column:
        draw = seeded(seed, F.lit("how"), key, at)
        random_word = (
            seeded(seed, F.lit("word"), key, at) % (VOCABULARY - FIRST_WORD) + FIRST_WORD
        ).cast("int")
        chosen = F.element_at(targets, at + 1) != IGNORED
        return (
            F.when(chosen & (draw % 1000 < REPLACED_PERMILLE), F.lit(MASK))
            .when(chosen & (draw % 1000 < RANDOM_PERMILLE), random_word)
            .otherwise(token)
        )

    return F.transform(ids, replace)


def pad_to(values: Column, length: Column, filler: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(filler), (length - F.size(values)).cast("int")))


def attention_mask(values: Column, length: Column) -> Column:
    return F.concat(
        F.transform(values, lambda _: F.lit(1)),
        F.array_repeat(F.lit(0), (length - F.size(values)).cast("int")),
    )


def target_count(targets: Column) -> Column:
    return F.size(F.filter(targets, lambda label: label != IGNORED))


def has_non_finite(values: Column) -> Column:
    return F.exists(
        values, lambda x: F.isnan(x) | (F.abs(x) == float("inf")) | x.isNull()
    )
