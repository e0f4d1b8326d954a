"""Column functions that clean labels. All of them run in the JVM."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blocks whose characters are folded to ASCII: Latin, general punctuation to number forms, Latin ligatures.
FOLDED_BLOCKS = ((0x00A0, 0x0250), (0x1E00, 0x1F00), (0x2000, 0x2190), (0xFB00, 0xFB07))


@lru_cache
def _folds() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters that become one ASCII character, those characters, and (character, several characters)."""
    single, target, several = [], [], []
    for low, high in FOLDED_BLOCKS:
        for c in map(chr, range(low, high)):
            plain = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
            if len(plain) == 1:
                single.append(c)
                target.append(plain)
            elif plain:
                several.append((c, plain))
    return "".join(single), "".join(target), tuple(several)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_ascii(text) -> Column:
    """Compatibility decomposition without what isn't ASCII."""
    single, target, several = _folds()
    out = F.translate(_col(text), single, target)
    # Few texts hold the rest, so its replacements run for those alone.
    rest = reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), several, out)
    out = F.when(out.rlike("[^\\x00-\\x7F]"), rest).otherwise(out)
    return F.regexp_replace(out, "[^\\x00-\\x7F]", "")


def normalize_label(text) -> Column:
    """White space collapsed, ligatures spelt out, folded to ASCII, lower case; not trimmed."""
    out = F.regexp_replace(_col(text), "(?U)\\s+", " ")
    for old, new in (("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.lower(fold_ascii(out))


def remove_noise(text) -> Column:
    """The empty word "rien", punctuation, digits and one-letter words go; null becomes a space first."""
    out = F.coalesce(_col(text), F.lit(" "))
    out = F.regexp_replace(out, "(?U)\\brien\\b|\\rien du tout\\b", "")
    out = F.regexp_replace(out, "(?U)[^\\w\\s]+", " ")
    out = F.regexp_replace(out, "(?U)\\brien\\b|\\rien du tout\\b", "")
    out = F.regexp_replace(out, "(?U)[\\d+]", " ")
    return F.array_join(F.filter(F.split(F.trim(out), "(?U)\\s+"), lambda w: F.length(w) > 1), " ")


def strong_clean(text, stopwords: list[str]) -> Column:
    """Noise out, repeated words out, stop words out, ASCII; null where nothing was left before the stop words went."""
    noted = F.array_distinct(F.split(remove_noise(F.lower(_col(text))), " "))
    plain = F.array_join(noted, " ")
    kept = F.filter(noted, lambda w: ~F.array_contains(F.lit(list(stopwords)) if stopwords else F.array().cast("array<string>"), w))
    return F.when(F.length(F.trim(plain)) > 0, fold_ascii(F.array_join(kept, " ")))


# What transliteration writes for characters that compatibility decomposition has no letters for.
TRANSLITERATED = (("€", "EUR"), ("ß", "ss"), ("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE"), ("Ø", "O"), ("ø", "o"), ("Đ", "D"), ("đ", "d"), ("Ł", "L"), ("ł", "l"), ("Þ", "Th"), ("þ", "th"), ("Ð", "D"), ("ð", "d"), ("’", "'"), ("‘", "'"), ("“", '"'), ("”", '"'), ("«", "<<"), ("»", ">>"), ("–", "-"), ("—", "--"), ("°", "deg"), ("×", "x"), ("£", "PS"))


def transliterate(text) -> Column:
    """ASCII that is read like the text: letters without accents, ligatures and signs spelt out; other characters go."""
    return fold_ascii(reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), TRANSLITERATED, F.coalesce(_col(text), F.lit(""))))


def classifier_clean(text, stopwords: list[str]) -> Column:
    """Transliterated, lower case, noise and repeated words out, stop words out; null where nothing was left before the stop words went."""
    noted = F.array_distinct(F.split(remove_noise(F.lower(transliterate(text))), " "))
    kept = F.filter(noted, lambda w: ~F.array_contains(F.lit(list(stopwords)) if stopwords else F.array().cast("array<string>"), w))
    return F.when(F.length(F.trim(F.array_join(noted, " "))) > 0, F.array_join(kept, " "))


def price(text) -> Column:
    """The leading number after // is gone and a comma is a point; null without one."""
    digits = F.regexp_extract(F.replace(F.replace(_col(text), F.lit("//"), F.lit("")), F.lit(","), F.lit(".")), "^[0-9]+(\\.[0-9]+)?", 0)
    return F.nullif(digits, F.lit("")).cast("double")


def amount(text) -> Column:
    """The whole text as a number, a comma as a point; null if it isn't one."""
    return F.replace(F.trim(_col(text)), F.lit(","), F.lit(".")).try_cast("double")


def metric_key(text) -> Column:
    return F.regexp_replace(_col(text), "[^a-zA-Z0-9_\\-.]", "_")


#: Fixed: parts of lines that introduce a list rather than belong to it.
LIST_INTRODUCTIONS = ("voici", "voilà", "exemples", "catégorie", "coicop", "produits pour", "produits de", "ci-dessous", "suivants")
LONGEST_ITEM = 80


def list_items(response) -> Column:
    """Items of a bulleted or numbered answer: no introductions, no long lines, no bullets or numbers."""
    lines = F.transform(F.split(F.trim(_col(response)), "\n"), lambda x: F.trim(x))
    intro = "(?iu)" + "|".join(LIST_INTRODUCTIONS)
    kept = F.filter(lines, lambda x: (F.length(x) > 0) & (F.length(x) <= LONGEST_ITEM) & ~F.regexp_like(x, F.lit(intro)))
    bare = F.transform(kept, lambda x: F.regexp_replace(x, "^(- |• |\\* |– )", ""))
    plain = F.transform(bare, lambda x: F.when(F.regexp_like(x, F.lit("^[0-9]{1,2}[.):].")), F.trim(F.regexp_replace(x, "^[0-9]{1,2}[.):]", ""))).otherwise(x))
    return F.filter(plain, lambda x: F.length(x) > 0)
