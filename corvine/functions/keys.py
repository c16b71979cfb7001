"""Blocking keys as Column expressions over normalized text: arrays of keys in order of generation, without repeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvine.functions.text import WHITE

PREFIX = 4
#: Words that don't tell names apart.
NAME_STOPWORDS = """
a ag america american an and as associate associates at business by center centre co com commercial company consultant
consultants consulting corp corporation dba doing dr enterprise enterprises eurl for france french global gmbh group holding
holdings in inc incorporated india indian industries industry international io liability limited llc llp ltd management mr mrs
ms national net of on operating org partner partners plc private proprietary pty pvt responsabilite sa sarl sas sasu service
services shri simplifiee smt societe solution solutions sri tech technologies technology the to trading unipersonnelle usa
with www
""".split()
#: Words that don't tell addresses apart.
ADDRESS_STOPWORDS = """
allee allée and apartment apt at ave avenue behind beside bh bldg blk block blvd boulevard box building central ch chemin cir
circle colony complex court ct door dr drive east enclave fl flat floor for highway hno house hwy impasse in lane ln na nagar
near new no none north null of old on opp opposite parkway phase pkwy pl place plot po pob post rd rm road room route rte rue
sec sector shop south st ste street suite ter terrace the to tower trail trl unit way west
""".split()
#: Phrases between a legal and a trade name.
ALIASES = r"(?<![\p{L}\p{N}_])(?:dba|doing business as|d/b/a|t/a|trading as)(?![\p{L}\p{N}_])"
_WORD = r"[\p{L}\p{N}_]"
#: Kinds of keys in order of priority.
TIERS = ("ANW_", "NF_", "AWP_", "NS_", "NS2_")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _tokens(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda t: t != "")


def _with(value: Column, make: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for all its uses in what ``make`` builds."""
    return F.element_at(F.transform(F.array(value), make), 1)


def name_keys(name: Column, prefix: int = PREFIX) -> Column:
    """NF_: the first telling word of each alias; NS_, NS2_: the first two of all telling words in order."""
    stop = _strings(NAME_STOPWORDS)

    def telling(part: Column) -> Column:
        return F.filter(_tokens(part), lambda t: ~F.array_contains(stop, t) & (F.length(t) >= 2) & t.rlike(_WORD))

    def keys(parts: Column) -> Column:
        """parts: telling words by alias, none empty."""
        first = F.transform(parts, lambda p: F.concat(F.lit("NF_"), F.substring(F.element_at(p, 1), 1, prefix)))
        ordered = F.array_sort(F.array_distinct(F.flatten(parts)))
        rest = F.transform(F.slice(ordered, 1, 2), lambda t, i: F.concat(F.when(i == 0, "NS_").otherwise("NS2_"), F.substring(t, 1, prefix)))
        return F.array_distinct(F.concat(first, rest))

    # Where no word tells, all words stand in, as one part.
    def whole(parts: Column) -> Column:
        return F.when(F.size(parts) > 0, keys(parts)).otherwise(_fallback_keys(name, prefix))

    parts = F.filter(F.transform(F.split(name, ALIASES), telling), lambda p: F.size(p) > 0)
    return F.when(F.coalesce(name, F.lit("")) == "", F.array().cast("array<string>")).otherwise(_with(parts, whole))


def _fallback_keys(name: Column, prefix: int) -> Column:
    def keys(words: Column) -> Column:
        first = F.transform(F.slice(words, 1, 1), lambda t: F.concat(F.lit("NF_"), F.substring(t, 1, prefix)))
        rest = F.transform(F.slice(F.array_sort(F.array_distinct(words)), 1, 2), lambda t, i: F.concat(F.when(i == 0, "NS_").otherwise("NS2_"), F.substring(t, 1, prefix)))
        return F.array_distinct(F.concat(first, rest))

    return _with(F.filter(_tokens(name), lambda t: t.rlike(_WORD)), keys)


def _ascii_digits() -> tuple[str, str]:
    """All decimal digits of Unicode, and the ASCII digits in their place."""
    every = [chr(i) for i in range(128, 0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isdecimal() and i < 0x10000]
    return "".join(every), "".join(str(int(c)) for c in every)


def address_keys(address: Column, prefix: int = PREFIX) -> Column:
    """ANW_: the first two numbers with the first three and the last telling word; AWP_: pairs of the first three words in order."""
    stop, (digits, plain) = _strings(ADDRESS_STOPWORDS), _ascii_digits()

    def number(t: Column) -> Column:
        ascii_only = F.when(F.octet_length(t) == F.length(t), t).otherwise(F.translate(t, digits, plain))
        return F.when(t.rlike(r"^\p{Nd}{1,8}$"), ascii_only).try_cast("long")

    def build(tokens: Column) -> Column:
        numbers = F.slice(F.array_distinct(F.filter(F.transform(tokens, number), lambda n: n > 0)), 1, 2)
        words = F.filter(tokens, lambda t: ~t.rlike(r"^[\p{Nd}\p{No}]+$") & ~F.array_contains(stop, t) & (F.length(t) >= 3) & t.rlike(_WORD))

        def keys(w: Column) -> Column:
            near = F.concat(F.slice(w, 1, 3), F.when(F.size(w) > 3, F.slice(w, -1, 1)).otherwise(F.array().cast("array<string>")))
            first = F.flatten(F.transform(numbers, lambda n: F.transform(near, lambda x: F.concat(F.lit("ANW_"), n.cast("string"), F.lit("_"), F.substring(x, 1, prefix)))))

            def pairs(s: Column) -> Column:
                pick = lambda i: F.substring(F.get(s, i), 1, prefix)
                return F.array_compact(F.array(*[F.concat(F.lit("AWP_"), pick(a), F.lit("_"), pick(b)) for a, b in ((0, 1), (0, 2), (1, 2))]))

            return F.array_distinct(F.concat(first, _with(F.slice(F.array_sort(F.array_distinct(w)), 1, 3), pairs)))

        return _with(words, keys)

    return F.when(F.coalesce(address, F.lit("")) == "", F.array().cast("array<string>")).otherwise(_with(_tokens(address), build))


def blocking_keys(name: Column, address: Column, prefix: int = PREFIX) -> Column:
    return F.array_distinct(F.concat(address_keys(address, prefix), name_keys(name, prefix)))


def tier(key: Column) -> Column:
    """Priority of a key, 1 first."""
    out = F.when(F.startswith(key, F.lit(TIERS[0])), 1)
    for i, kind in enumerate(TIERS[1:], 2):
        out = out.when(F.startswith(key, F.lit(kind)), i)
    return out.otherwise(len(TIERS) + 1)


def clean_country(country: Column) -> Column:
    return F.coalesce(F.regexp_replace(country, f"^{WHITE}|{WHITE}$", ""), F.lit(""))
