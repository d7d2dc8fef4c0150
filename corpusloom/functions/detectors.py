"""Signs of a bad translation, as Column builders over (source, target). Nulls count as empty texts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import known, normalized, once, sentences, squeezed, stripped, tokens

# Function words by language.
FUNCTION_WORDS = {
    "it": (
        "il lo la i gli le un uno una e o ma se che questo questa questi queste io tu lui lei noi voi loro mi ti si ci vi mio mia tuo tua "
        "suo sua nostro vostro è sono era erano essere stato stata ho hai ha hanno aveva avevano fare fa non no mai di a da in su per con "
        "senza come tra fra prima dopo quando dove chi quale cosa perché così molto più alcuni ogni altro altra qui lì solo della delle "
        "degli del dei alla alle allo agli nel nella nelle nello nei dal dalla dalle dallo dai sul sulla sulle sullo sui anche ancora "
        "quella quello mentre verso tutto tutti tutte dovrebbe potrebbe avevo abbiamo"
    ),
    "en": (
        "the a an and or but if then than that this these those i you he she it we they me him her us them my your his its our their is am "
        "are was were be been being have has had do does did will would shall should can could may might must not no never of to in on at "
        "by for from with without as into over under up down out about before after when where who which what why how so very more most "
        "some any all each every"
    ),
    "fr": (
        "le la les un une des du de et ou mais si que qui je tu il elle nous vous ils elles me te se ce cette ces mon ma mes son sa ses "
        "notre votre leur est sont était étaient être avoir ai a ont avait avaient ne pas jamais rien personne dans sur sous avec sans "
        "pour par avant après quand où comme plus moins tout tous toute toutes"
    ),
    "de": (
        "der die das ein eine einer eines und oder aber wenn dass ich du er sie es wir ihr mich dich ihn uns mein dein sein unser euer ist "
        "sind war waren haben hat hatte nicht kein keine keinen niemals nie nichts niemand von zu in auf an bei für mit ohne als über unter "
        "vor nach wo wer was"
    ),
    "ru": (
        "и а но или если что это этот эта я ты он она оно мы вы они мне тебе его ее наш ваш их есть был была были быть иметь не нет никогда "
        "ни из в на к по для с без как над под до после когда где кто который почему"
    ),
}
# Cues of boilerplate, words of our time, marks of a work's end.
BOILERPLATE = [
    r"project gutenberg",
    r"gutenberg license",
    r"grosset\s*&\s*dunlap",
    r"more to follow",
    r"other side of the wrapper",
    r"wherever books are sold",
    r"publishers?,?\s+new york",
]
MODERN = r"(?i)\b(?:film|cinema|televisione|tv|streaming|podcast|internet|website|sito web|isbn|edizione digitale)\b"
END_MARKERS = ["the end", "end", "finis", "fine", "la fine", "ende", "конец", "τέλος"]
SCRIPTS = {"ru": r"[\x{0400}-\x{052f}]", "grc": r"[\x{0370}-\x{03ff}\x{1f00}-\x{1fff}]", "el": r"[\x{0370}-\x{03ff}\x{1f00}-\x{1fff}]"}


def function_words(language: str) -> list[str]:
    return FUNCTION_WORDS[language].split()


def ratio(source: Column, target: Column) -> Column:
    return F.length(known(target)) / F.greatest(F.lit(1), F.length(known(source)))


def named(*flags: tuple[str, Column]) -> Column:
    """The names of the flags that hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in flags]))


class Forms(NamedTuple):
    """Columns that several detectors read: how many sentences the source has, and the target's sentences, folded."""

    source_sentences: Column
    target_norms: Column


def prepared(pairs: DataFrame, source: str = "source", target: str = "translation") -> tuple[DataFrame, Forms]:
    """pairs with the forms of its texts as columns, so that sentences are cut once for all detectors."""
    norms = F.transform(sentences(known(F.col(target))), normalized)
    found = pairs.withColumns({"_source_sentences": F.size(sentences(known(F.col(source)))), "_target_norms": norms})
    return found, Forms(F.col("_source_sentences"), F.col("_target_norms"))


def forms_of(source: Column, target: Column) -> Forms:
    return Forms(F.size(sentences(known(source))), F.transform(sentences(known(target)), normalized))


def omission(source: Column, target: Column, forms: Forms | None = None) -> Column:
    """Likely dropped prose: fewer sentences than a source of two or more, or much shorter."""
    n, norms = forms or forms_of(source, target)
    fewer = (n >= 2) & (F.size(norms) < n)
    return (F.length(known(source)) >= 90) & (fewer | (ratio(source, target) < 0.62))


def adjacent_repeat(target: Column, forms: Forms | None = None) -> Column:
    """A sentence of more than 35 characters that is the same as the one before it."""

    def repeats(norm: Column) -> Column:
        n = F.greatest(F.size(norm) - 1, F.lit(0))
        return F.exists(F.zip_with(F.slice(norm, 1, n), F.slice(norm, 2, n), lambda a, b: (a == b) & (F.length(b) > 35)), lambda x: x)

    return repeats(forms.target_norms) if forms else once(F.transform(sentences(known(target)), normalized), repeats)


def halves_repeat(target: Column) -> Column:
    """More than 100 characters, the second half of which says the same as the first."""
    text = stripped(F.regexp_replace(known(target), r"[\s\x{00a0}]+", " "))
    middle = F.floor(F.length(text) / 2).cast("int")
    left = squeezed(F.substring(text, F.lit(1), middle))
    right = squeezed(F.substring(text, middle + 1, F.length(text)))
    return (F.length(text) > 100) & (left != "") & (left == right)


def repetition(source: Column, target: Column, forms: Forms | None = None) -> Column:
    return adjacent_repeat(target, forms) | halves_repeat(target) | (ratio(source, target) > 1.75)


def translation_risk(source: Column, target: Column, forms: Forms | None = None) -> Column:
    return omission(source, target, forms) | repetition(source, target, forms)


def script_count(x: Column, language: str) -> Column:
    """Letters of the source language's own script."""
    return F.regexp_count(known(x), F.lit(SCRIPTS[language])) if language in SCRIPTS else F.lit(0)


def empty(target: Column) -> Column:
    return stripped(known(target)) == ""


def sentence_seen_before(target: Column) -> Column:
    """A sentence of 35 characters or more that stands twice; the near-equal arm is in operators.similarity."""
    long = F.filter(F.transform(sentences(known(target)), normalized), lambda s: F.length(s) >= 35)
    return F.size(F.array_distinct(long)) < F.size(long)


def hard_flags_repair(source: Column, target: Column, language: str, repeated: Column | None = None) -> Column:
    """What blocks a release after repair. repeated: operators.similarity.repeated_span of target, for near-equal sentences, too."""
    off = (F.length(known(source)) >= 90) & ((ratio(source, target) < 0.30) | (ratio(source, target) > 2.75))
    return named(
        ("empty", empty(target)),
        ("source_script_spillover", script_count(target, language) > 0),
        ("severe_length_anomaly", off),
        ("decoder_repetition", sentence_seen_before(target) if repeated is None else repeated),
    )


def word_five_times(target: Column) -> Column:
    # a word and what stands between words have no sign in common, so neither is tried again shorter
    return F.regexp_like(known(target), F.lit(r"(?i)\b([a-zà-ÿ]{3,}+)(?:[\s,.;:!?—-]++\1){4,}\b"))


def hard_flags_targeted(source: Column, target: Column, loops: bool = True) -> Column:
    """What sends a unit to the targeted repair. loops: with the arm for a word said five times over."""
    t = known(target)
    s_len, t_len = F.length(stripped(known(source))), F.length(stripped(t))
    part = t_len / F.greatest(F.lit(1), s_len)
    return named(
        ("empty_target", t_len == 0),
        ("cyrillic_spillover", F.regexp_like(t, F.lit(r"[\x{0400}-\x{04ff}]"))),
        ("greek_spillover", F.regexp_like(t, F.lit(r"[\x{0370}-\x{03ff}]"))),
        ("long_digit_run", F.regexp_like(t, F.lit(r"\d{7,}"))),
        *([("decoder_repetition", word_five_times(target))] if loops else []),
        ("severe_underlength", (s_len >= 20) & (part < 0.18)),
        ("severe_overlength", (s_len >= 20) & (part > 2.40)),
    )


#: Likeness to the source from which a text counts as not translated, and the languages for which it does.
ALIKE, LIKENESS_COUNTS = 0.72, ("en", "fr", "de")


def score(source: Column, target: Column, kind: Column, language: str, similarity: Column | None = None, forms: Forms | None = None) -> Column:
    """A candidate's badness. similarity: to the source, 0 where that isn't asked for."""
    r = ratio(source, target)
    like = F.lit(0.0) if similarity is None else similarity
    value = (
        2500.0 * script_count(target, language)
        + F.when((kind != "heading") & translation_risk(source, target, forms), 1200.0).otherwise(0.0)
        + F.when((F.lit(language).isin(*LIKENESS_COUNTS)) & (like >= ALIKE), 900.0 + 500.0 * like).otherwise(0.0)
        + F.when(r < 0.48, (0.48 - r) * 1500.0).otherwise(0.0)
        + F.when(r > 1.85, (r - 1.85) * 900.0).otherwise(0.0)
    )
    return F.when(empty(target), F.lit(1000000.0)).otherwise(value)


def duplicate_half(source_tokens: Column, target_tokens: Column) -> Column:
    """An even number of four or more tokens, the halves of which are equal, unless the source is like this, too."""

    def halved(t: Column) -> Column:
        half = F.floor(F.size(t) / 2).cast("int")
        return (F.size(t) % 2 == 0) & (F.slice(t, 1, half) == F.slice(t, half + 1, half))

    return (F.size(target_tokens) >= 4) & halved(target_tokens) & ~halved(source_tokens)


def decoder_loop(target: Column) -> Column:
    """One sign six times, letters or a word four times over.

    What eight letters don't follow is passed at once, and words aren't tried again shorter, as no sign between words is a letter."""
    t = known(target)
    return (
        F.regexp_like(t, F.lit(r"([^\p{L}\p{N}_\s])\1{5}"))
        | F.regexp_like(t, F.lit(r"(?iu)(?=\p{L}{8})([a-zà-öø-ÿ]{2,15})\1{3}"))
        | F.regexp_like(t, F.lit(r"(?iuU)\b([a-zà-öø-ÿ]{2,25}+)(?:[.\s_-]++\1){3,}\b"))
    )


#: Cyrillic and Greek letters; what lies outside of both is passed at once.
_ALIEN = r"[\x{386}-\x{451}&&[А-Яа-яЁёΑ-ωΆ-ώ]]"


def source_residue(target: Column, target_tokens: Column, language: str, into: str = "it") -> Column:
    """Cyrillic or Greek letters, or four or more function words of the source language, and more of them than of the target's."""
    own, other = function_words(into), function_words(language)
    alien = [w for w in dict.fromkeys(other) if w not in set(own)]
    # membership of literals, which is looked up in a hash set
    ours = F.size(F.filter(target_tokens, lambda w: w.isin(*own)))
    theirs = F.size(F.filter(target_tokens, lambda w: w.isin(*alien)))
    return F.regexp_like(known(target), F.lit(_ALIEN)) | ((theirs >= 4) & (theirs > ours))


#: Tokens of a copied phrase, at least and at most, and function words of the source's language in it, at least.
COPIED, COPIED_WORDS = (5, 18), 2


def source_copy(source_tokens: Column, target_tokens: Column, language: str) -> Column:
    """A phrase of 5 to 18 tokens that both have, with two function words or more of the source's language in it."""
    least, most = COPIED

    def phrases(t: Column, size: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(t) - size + 1), lambda i: F.array_join(F.slice(t, i, size), " "))

    def shared(size: Column) -> Column:
        telling = F.filter(
            F.sequence(F.lit(1), F.size(source_tokens) - size + 1),
            lambda i: F.size(F.filter(F.slice(source_tokens, i, size), lambda w: w.isin(*function_words(language)))) >= COPIED_WORDS,
        )
        own = F.transform(telling, lambda i: F.array_join(F.slice(source_tokens, i, size), " "))
        return F.arrays_overlap(own, phrases(target_tokens, size))

    long = (F.size(source_tokens) >= least) & (F.size(target_tokens) >= least)
    # without a shared phrase of the least size there is no longer one
    any_ = F.when(long, F.arrays_overlap(phrases(source_tokens, F.lit(least)), phrases(target_tokens, F.lit(least)))).otherwise(False)
    sizes = F.sequence(F.lit(least), F.least(F.lit(most), F.size(source_tokens), F.size(target_tokens)))
    return F.when(any_, F.exists(sizes, shared)).otherwise(False)


def unmatched_repetition(source_repeat: Column, target_repeat: Column) -> Column:
    """A block said again at once in the target, three times or of four tokens at least, and clearly more than in the source.

    Both are structs of operators.similarity.repeated_adjacent."""
    times = F.greatest(source_repeat["count"], F.lit(1))
    more = (target_repeat["count"] > times) | (target_repeat["score"] >= source_repeat["score"] + 4)
    strong = (target_repeat["count"] >= 3) | (target_repeat["size"] >= 4)
    return (target_repeat["count"] > 0) & more & strong


def token_length_anomaly(source_tokens: Column, target_tokens: Column) -> Column:
    r = F.size(target_tokens) / F.greatest(F.lit(1), F.size(source_tokens))
    return (F.size(source_tokens) >= 8) & ((r > 2.5) | (r < 0.35))


def modern_intrusion(source: Column, target: Column) -> Column:
    return F.regexp_like(known(target), F.lit(MODERN)) & ~F.regexp_like(known(source), F.lit(MODERN))


def boilerplate(x: Column, cues: Sequence[str] = BOILERPLATE) -> Column:
    return F.regexp_like(known(x), F.lit("(?i)" + "|".join(cues)))


def post_failures(source: Column, target: Column, language: str) -> Column:
    """What rejects a corrected unit; weaker than what selected it."""
    s, t = tokens(known(source)), tokens(known(target))
    return named(
        ("empty_target", empty(target)),
        ("decoder_loop", decoder_loop(target)),
        ("source_language_residue", source_residue(target, t, language)),
        ("exact_duplicate_half", duplicate_half(s, t)),
        ("severe_length_anomaly", token_length_anomaly(s, t)),
        ("modern_intrusion", modern_intrusion(source, target)),
    )


def status(flagged: Column, hard: Column) -> Column:
    """FAIL with hard flags, REVIEW_REQUIRED with others, else PASS."""
    return F.when(hard > 0, "FAIL").when(flagged > 0, "REVIEW_REQUIRED").otherwise("PASS")
