"""Languages of books: noisy values to base subtags, by rules that run once per distinct value."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Two-letter language codes (ISO 639-1).
CODES = (
    "aa ab ae af ak am an ar as av ay az ba be bg bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr fy ga gd gl gn "
    "gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml "
    "mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te "
    "tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
).split()
#: Three-letter codes that catalogues use beside them.
LONG_CODES = "orv krc xal udm und chv mhr mrj myv mdf sah tyv kjh kum lez nog ady kbd inh grc ang enm fro gmh goh non egy akk syr cop got chu rus eng ger fra".split()
#: Three-letter codes with a two-letter form.
SHORT = {"rus": "ru", "eng": "en", "ger": "de", "deu": "de", "fra": "fr", "fre": "fr", "spa": "es", "ita": "it", "ukr": "uk", "bel": "be", "pol": "pl", "chv": "cv", "chu": "cu", "iw": "he", "sh": "sr", "mo": "ro", "tl": "fil", "no": "nb"}
#: Default aliases of known noisy values.
ALIASES = {
    "gr": "el", "sp": "es", "tu": "tr", "dk": "da", "jp": "ja", "ua": "uk", "po": "pl", "bl": "bg", "ud": "udm", "esp": "es", "dat": "da", "cz": "cs", "tm": "tk",
    "kz": "kk", "gm": "de", "dr": "orv", "un": "und", "pentjab": "pa", "balkar": "krc", "кг": "ru", "u": "uk", "C": "ru", "by": "ru", "ok": "pl", "ан": "en",
    "рус": "ru", "ukrian": "uk", "urkain": "uk", "xx": "ru", "Человеческое, слишком человеческое": "ru",
}
#: Display names by locale, in the order of their codes.
NAMES = {
    "en": {"be": "Belarusian", "bg": "Bulgarian", "cs": "Czech", "da": "Danish", "de": "German", "el": "Greek", "en": "English", "eo": "Esperanto", "es": "Spanish", "et": "Estonian",
           "fi": "Finnish", "fr": "French", "he": "Hebrew", "hu": "Hungarian", "it": "Italian", "ja": "Japanese", "ka": "Georgian", "kk": "Kazakh", "la": "Latin", "lt": "Lithuanian",
           "lv": "Latvian", "nl": "Dutch", "pl": "Polish", "pt": "Portuguese", "ro": "Romanian", "ru": "Russian", "sk": "Slovak", "sr": "Serbian", "sv": "Swedish", "tr": "Turkish",
           "tt": "Tatar", "uk": "Ukrainian", "uz": "Uzbek", "zh": "Chinese"},
    "ru": {"be": "белорусский", "bg": "болгарский", "cs": "чешский", "da": "датский", "de": "немецкий", "el": "греческий", "en": "английский", "eo": "эсперанто", "es": "испанский",
           "et": "эстонский", "fi": "финский", "fr": "французский", "he": "иврит", "hu": "венгерский", "it": "итальянский", "ja": "японский", "ka": "грузинский", "kk": "казахский",
           "la": "латинский", "lt": "литовский", "lv": "латышский", "nl": "нидерландский", "pl": "польский", "pt": "португальский", "ro": "румынский", "ru": "русский", "sk": "словацкий",
           "sr": "сербский", "sv": "шведский", "tr": "турецкий", "tt": "татарский", "uk": "украинский", "uz": "узбекский", "zh": "китайский"},
    "bg": {"bg": "български", "de": "немски", "en": "английски", "es": "испански", "fr": "френски", "it": "италиански", "pl": "полски", "ru": "руски", "sr": "сръбски", "uk": "украински"},
}


@dataclass(frozen=True)
class ContextRule:
    """A value that means another language where a record's source language says so."""

    value: str
    means: str
    sources: tuple[str, ...]


#: Default context rules, for the source language only.
CONTEXT_RULES = (ContextRule("ba", "krc", ("krc", "balkar")), ContextRule("xa", "xal", ("xal",)))


def _key(value: str) -> str:
    return " ".join(value.lower().split())


@dataclass(frozen=True)
class Resolution:
    value: str
    method: str


@dataclass(frozen=True)
class LanguageRules:
    """Aliases, ignored patterns, display names and their order, context rules."""

    aliases: dict[str, str] = field(default_factory=lambda: dict(ALIASES))
    ignore: tuple[str, ...] = (r"^\?+$",)
    locales: tuple[str, ...] = ("en", "ru", "bg")
    names: dict[str, dict[str, str]] = field(default_factory=lambda: NAMES)
    context: tuple[ContextRule, ...] = CONTEXT_RULES

    def __post_init__(self) -> None:
        """Rules that cannot work are an error: aliases without a name or to no tag, patterns that are none, locales without names."""
        seen: dict[str, str] = {}
        for name, means in self.aliases.items():
            if not _key(name) or self.tag(means) is None:
                raise ValueError(f"alias {name!r} means {means!r}")
            if seen.setdefault(_key(name), means) != means:
                raise ValueError(f"alias {name!r} has two meanings")
        for pattern in self.ignore:
            try:
                re.compile(pattern)
            except re.error as error:
                raise ValueError(f"pattern {pattern!r}: {error}") from None
        if unknown := [x for x in self.locales if self.tag(x) is None]:
            raise ValueError(f"unknown locales: {unknown}")

    def tag(self, value: str) -> str | None:
        """The base subtag of a valid tag, or None. A tag's later parts must have a tag's form."""
        parts = re.split("[-_]", value)
        base = parts[0].lower()
        if not re.fullmatch("[A-Za-z]{2,3}", parts[0]) or not all(re.fullmatch("[A-Za-z0-9]{2,8}", p) for p in parts[1:]):
            return None
        base = SHORT.get(base, base)
        return base if base in CODES or base in LONG_CODES or base == "fil" else None

    def _named(self, value: str, locale: str) -> tuple[str, bool] | None:
        key, names = _key(value), self.names.get(locale, {})
        for code, name in names.items():
            if _key(name) == key:
                return code, False
        if len(key) >= 2:
            for code, name in names.items():
                if _key(name).startswith(key):
                    return code, True
        return None

    def resolve(self, value: str, *, context: str = "", is_source: bool = False, sources: tuple[str, ...] = ()) -> Resolution:
        """A value's base subtag and how it was found; method "ignored" or "unresolved" otherwise."""
        original = value.strip()
        aliases = {_key(k): v for k, v in self.aliases.items()}
        if _key(original) in aliases:
            return Resolution(aliases[_key(original)], "alias")
        parts, ignored = [], False
        for part in original.split(","):
            for clean in (part.strip(), re.sub(r"^[\W_]+|[\W_]+$", "", re.sub(r"\\[nrt]", " ", part).strip())):
                if clean and any(re.search(p, clean) for p in self.ignore):
                    ignored = True
                    break
            else:
                if clean:
                    parts.append(clean)
        if not parts:
            return Resolution("", "ignored" if ignored else "unresolved") if ignored else Resolution(original, "unresolved")
        for part in parts:
            split = "" if part == original else "split_"
            if is_source:
                for rule in self.context:
                    if rule.value == _key(part) and {_key(s) for s in sources} & {_key(s) for s in rule.sources}:
                        return Resolution(rule.means, "context_source_language")
            if tag := self.tag(part):
                return Resolution(tag, f"{split}valid_tag")
            if _key(part) in aliases:
                return Resolution(aliases[_key(part)], f"{split}alias")
            told = {"en": "english", "ru": "russian", "bg": "bulgarian"}
            tried = ([(self.tag(context), "context")] if context and self.tag(context) else []) + [(x, told.get(x, "fallback")) for x in self.locales]
            for locale, label in tried:
                if found := self._named(part, locale):
                    return Resolution(found[0], f"{split}{label}_display_name{'_prefix' * found[1]}")
        return Resolution(original, "unresolved")


def language_table(values: DataFrame, rules: LanguageRules) -> DataFrame:
    """(value, context, language, method) for the distinct pairs of a frame with value and context."""
    import pandas as pd

    def run(batches):
        for pdf in batches:
            found = [rules.resolve(v, context=c or "") for v, c in zip(pdf["value"], pdf["context"], strict=True)]
            yield pd.DataFrame({"value": pdf["value"], "context": pdf["context"], "language": [f.value for f in found], "method": [f.method for f in found]})

    distinct = values.select(F.trim("value").alias("value"), F.coalesce("context", F.lit("")).alias("context")).where("value <> ''").distinct()
    return distinct.mapInPandas(run, "value string, context string, language string, method string")


def canonical_language(df: DataFrame, rules: LanguageRules | None = None, *, db: str = "db_lang", fb2: str = "fb2_lang", db_source: str | None = None, fb2_source: str | None = None) -> DataFrame:
    """df with language and language_method: the catalogue's value, or the book's where that is absent or ignored.

    An unresolved value is kept as it is and blocks the next one. Rules run on distinct values; the
    table of these joins back by value, so a common value costs no more than a rare one.
    """
    rules = rules or LanguageRules()
    none = F.lit("")
    pick = [(F.col(db), F.col(db_source) if db_source else none), (F.col(fb2), F.col(fb2_source) if fb2_source else none)]
    values = None
    for value, context in pick:
        part = df.select(value.alias("value"), context.alias("context"))
        values = part if values is None else values.union(part)
    table = language_table(values, rules)
    for i, (value, context) in enumerate(pick):
        known = table.select(F.col("value").alias(f"_v{i}"), F.col("context").alias(f"_c{i}"), F.col("language").alias(f"_l{i}"), F.col("method").alias(f"_m{i}"))
        df = df.join(known, (F.trim(value) == F.col(f"_v{i}")) & (F.coalesce(context, none) == F.col(f"_c{i}")), "left")
    use = F.col("_m0").isNotNull() & (F.col("_m0") != "ignored")
    second = F.col("_m1").isNotNull() & (F.col("_m1") != "ignored")
    chosen = lambda c: F.when(use, F.col(f"_{c}0")).when(second, F.col(f"_{c}1")).otherwise("")
    return df.withColumns({"language": chosen("l"), "language_method": chosen("m")}).drop(*[f"_{c}{i}" for c in "vclm" for i in range(2)])
