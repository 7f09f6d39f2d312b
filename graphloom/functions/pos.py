"""Part-of-speech predicates over a tag list. True means "flag for removal", except for :func:`ends_with_noun`.

An empty or null list gives null in the first/last tag tests, which callers read as "not flagged".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first(tags: Column) -> Column:
    return F.try_element_at(tags, F.lit(1))


def _tag_list(*tags: str) -> Column:
    return F.array(*[F.lit(t) for t in tags])


def starts_with_verb(tags: Column) -> Column:
    """Begins with a verb tag, unless the list is exactly [VBN, NN]."""
    return _first(tags).startswith("VB") & (tags != _tag_list("VBN", "NN"))


def starts_with_space(tags: Column) -> Column:
    return _first(tags).startswith("_SP")


def starts_with_colon(tags: Column) -> Column:
    return _first(tags).startswith(":")


def starts_with_adverb(tags: Column) -> Column:
    return _first(tags).startswith("RB")


def has_bad_char(tags: Column) -> Column:
    return F.contains(F.array_join(tags, " "), F.lit("€"))


def ends_with_noun(tags: Column) -> Column:
    """Keep condition: the last tag is any noun tag."""
    return F.try_element_at(tags, F.lit(-1)).startswith("NN")


def bad_number_ratio(tags: Column) -> Column:
    """More than a third of the tags are numbers."""
    return F.size(F.filter(tags, lambda t: t == "CD")) * 3 > F.size(tags)


def bad_length(tags: Column) -> Column:
    """The tags together are shorter than four characters."""
    return F.length(F.array_join(tags, "")) < 4


def words_in_url(sequence: Column, page: Column) -> Column:
    """The phrase, hyphenated, occurs in the URL. Case counts."""
    return F.contains(page, F.replace(sequence, F.lit(" "), F.lit("-")))


def final_number_check(bad_ratio: Column, tags: Column, sequence: Column, page: Column) -> Column:
    """Number-heavy phrases stay flagged unless they are a number and a noun that the URL names."""
    number_noun = (tags == _tag_list("CD", "NN")) | (tags == _tag_list("CD", "NNS"))
    return bad_ratio & ~(bad_ratio & number_noun & words_in_url(sequence, page))


REMOVAL_FLAGS = {
    "starts_verb": starts_with_verb,
    "starts_space": starts_with_space,
    "starts_colon": starts_with_colon,
    "starts_adverb": starts_with_adverb,
    "bad_char": has_bad_char,
    "bad_cd_ratio": bad_number_ratio,
    "bad_length": bad_length,
}


def is_noun_phrase(tags: Column, **number_check: Column) -> Column:
    """Ends in a noun and carries no removal flag.

    Pass ``final_cd=<column>`` to judge numbers by :func:`final_number_check` in place of the plain ratio.
    """

    def judged(t: Column) -> Column:
        flags = {name: test(t) for name, test in REMOVAL_FLAGS.items()}
        if "final_cd" in number_check:
            flags["bad_cd_ratio"] = number_check["final_cd"]
        keep = F.coalesce(ends_with_noun(t), F.lit(False))
        for flag in flags.values():
            keep = keep & ~F.coalesce(flag, F.lit(False))
        return keep

    # Bound to one lambda variable: a pushed-down filter would otherwise build the tag list once per test.
    return F.get(F.transform(F.array(tags), judged), F.lit(0))
