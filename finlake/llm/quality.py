"""Quality rules, line first (DataFrame functions only).

Each line with a word is judged on its own: punctuation, navigation and boilerplate rules. Lines that fail are
removed, and a document that loses too much of its text is rejected.

Defined results: a null or blank text has no words and fails the base rules; lines are split at \\n, and those without a word
are never judged; extra columns pass through; a column that has the name of an added one is replaced. Every row is judged alone,
so ties and repeated rows need no order; an empty table gives no rows; a very long text, or line, takes time in
proportion to its length (its words times their logarithm, where windows of words recur).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import BLANKS, WORD, free_name, let, named, no_clash, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Phrases of page furniture, lower case, by language.
BOILERPLATE = {
    "en": ("all rights reserved", "accept cookies", "cookie policy", "cookie settings", "privacy policy", "terms of service", "terms of use", "enable javascript", "lorem ipsum", "subscribe to our", "click here to", "powered by"),
    "de": ("alle rechte vorbehalten", "cookies akzeptieren", "datenschutzerklärung", "nutzungsbedingungen", "newsletter abonnieren", "javascript aktivieren", "hier klicken"),
    "fr": ("tous droits réservés", "accepter les cookies", "politique de confidentialité", "conditions d'utilisation", "mentions légales", "activer javascript", "cliquez ici"),
    "es": ("todos los derechos reservados", "aceptar cookies", "política de privacidad", "condiciones de uso", "aviso legal", "activar javascript", "haga clic aquí"),
}
#: Words and phrases that are a menu entry where they are a whole line, by language.
MENU = {
    "en": ("home", "menu", "search", "login", "log in", "sign in", "sign up", "register", "next", "previous", "back to top", "read more", "share", "contact", "contact us", "about", "about us", "faq", "help", "sitemap", "print"),
    "de": ("startseite", "menü", "suche", "anmelden", "registrieren", "weiter", "zurück", "nach oben", "mehr lesen", "teilen", "kontakt", "über uns", "hilfe", "impressum", "drucken"),
    "fr": ("accueil", "rechercher", "connexion", "s'inscrire", "suivant", "précédent", "haut de page", "lire la suite", "partager", "à propos", "aide", "plan du site", "imprimer"),
    "es": ("inicio", "buscar", "iniciar sesión", "registrarse", "siguiente", "anterior", "volver arriba", "leer más", "compartir", "contacto", "acerca de", "ayuda", "mapa del sitio", "imprimir"),
}
MENU_LINE = "^(?:" + "|".join(re.escape(x) for words in MENU.values() for x in words) + r")[ .:>»]*$"
#: What opens a line of rights, and a word that is a link.
RIGHTS, _LINK = r"^\s*(?:©|\(c\)|&copy;|copyright\b)", r"(?:https?://|www\.)[^\x20\x09-\x0D]+"
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_bad_lines", "lost_chars", "clean_text", "kept")


@dataclass(frozen=True)
class LineRules:
    """min_words: base rule. max_repeat: base rule, percent of words. max_lost: share of a text's characters
    that bad lines may take. long_line: words from which a line needs a sentence mark. max_symbols and min_letters:
    shares of a line's characters. max_separators and max_links: shares of a line's words that are menu separators, or links."""

    min_words: int = 20
    max_repeat: int = 30
    max_lost: float = 0.5
    long_line: int = 12
    max_symbols: float = 0.1
    min_letters: float = 0.4
    max_separators: float = 0.2
    max_links: float = 0.5


def repeated_words(words: Column) -> Column:
    """Words inside 8-word windows that the text holds twice or more.

    Windows are compared by 64-bit hashes of 64-bit word hashes. Sorting (hash, place) pairs puts equal windows
    side by side; only texts with an equal pair pay for the sort."""

    def spread(sorted_: Column) -> Column:
        last = F.size(sorted_) - 1
        same = F.filter(
            sorted_,
            lambda x, j: ((j > 0) & (F.get(sorted_, j - 1)["h"] == x["h"])) | ((j < last) & (F.get(sorted_, j + 1)["h"] == x["h"])),
        )
        places = F.sort_array(F.transform(same, lambda x: x["i"]))
        start = F.struct(F.lit(-(1 << 30)).alias("at"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, i: F.struct(i.alias("at"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["at"])).alias("n"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def count(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(F.sort_array(pairs), spread))

    def windows(each: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(each) - WINDOW)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(each, i + k) for k in range(WINDOW)]))

    few = F.lit(0).cast("long")
    return F.when(F.size(words) <= WINDOW, few).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), lambda each: let(windows(each), count)))


def described(line: Column) -> Column:
    """A line with its size (characters that aren't blank), symbols and letters."""

    def counted(dense: Column) -> Column:
        size = F.length(dense).cast("long")
        return F.struct(
            line.alias("line"),
            size.alias("size"),
            (size - F.length(F.translate(dense, SYMBOLS, ""))).alias("symbols"),
            F.length(F.regexp_replace(dense, r"\P{L}+", "")).cast("long").alias("letters"),
        )

    return let(F.translate(line, BLANKS, ""), counted)


def bad_line(x: Column, rules: LineRules) -> Column:
    """Whether a described line with a word fails a rule. Words are counted only where a cheaper condition holds."""
    line, size = x["line"], x["size"]
    n = F.regexp_count(line, F.lit(WORD))
    punctuation = (x["symbols"] > rules.max_symbols * size) | (x["letters"] < rules.min_letters * size) | (~line.rlike(r"[.!?…。！？]") & (n >= rules.long_line))
    marks = F.lit(False)
    for mark in "|»›•·":
        marks = marks | line.contains(mark)
    marks = marks | line.contains(" > ") | line.contains(" / ")
    navigation = marks & (F.regexp_count(line, F.lit(r"(?<![^\x20\x09-\x0D])[|»›•·>/]+(?![^\x20\x09-\x0D])")) > rules.max_separators * n)
    links = (line.contains("://") | line.contains("www.")) & (F.regexp_count(line, F.lit(_LINK)) > rules.max_links * n)

    def furniture(lower: Column) -> Column:
        out = ((size < 20) & F.trim(lower).rlike(MENU_LINE)) | lower.rlike(RIGHTS)
        for phrases in BOILERPLATE.values():
            for phrase in phrases:
                out = out | lower.contains(phrase)
        return out

    return punctuation | navigation | links | let(F.lower(line), furniture)


def quality_rules(df: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """`df` with n_words, the base counts, base_failed, n_lines, n_bad_lines, lost_chars, clean_text and kept."""
    body = F.coalesce(named(text), F.lit(""))
    total = lambda lines, of: F.aggregate(lines, F.lit(0).cast("long"), lambda acc, x: acc + x[of])

    def by_word(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), repeated_words(words).alias("n_repeat_words"))

    def by_line(lines: Column) -> Column:
        def judged(bad: Column) -> Column:
            return F.struct(
                F.size(lines).cast("long").alias("n_lines"),
                (F.size(lines) - F.size(F.array_distinct(F.transform(lines, lambda x: x["line"])))).cast("long").alias("n_dup_lines"),
                total(lines, "size").alias("word_chars"),
                total(lines, "symbols").alias("n_symbols"),
                F.size(bad).cast("long").alias("n_bad_lines"),
                total(bad, "size").alias("lost_chars"),
            )

        return let(F.filter(lines, lambda x: bad_line(x, rules)), judged)

    lines = F.transform(F.split(body, "\n"), described)
    filled = F.filter(lines, lambda x: x["size"] > 0)
    w, each = free_name(df, "w"), free_name(df, "each")
    out = df.withColumns({w: let(words_of(body), by_word), each: let(filled, by_line)})
    out = no_clash(out, *[c for c in ADDED if c not in (w, each)]).select(
        "*",
        F.col(f"{w}.n_words"),
        F.col(f"{each}.word_chars"),
        F.col(f"{each}.n_symbols"),
        F.col(f"{each}.n_dup_lines"),
        F.col(f"{w}.n_repeat_words"),
        ((F.col(f"{w}.n_words") < rules.min_words) | (100 * F.col(f"{w}.n_repeat_words") > rules.max_repeat * F.col(f"{w}.n_words"))).alias("base_failed"),
        F.col(f"{each}.n_lines"),
        F.col(f"{each}.n_bad_lines"),
        F.col(f"{each}.lost_chars"),
    )
    clean = F.array_join(F.transform(F.filter(lines, lambda x: (x["size"] == 0) | ~bad_line(x, rules)), lambda x: x["line"]), "\n")
    return out.withColumns({"clean_text": clean, "kept": ~F.col("base_failed") & (F.col("lost_chars") <= rules.max_lost * F.col("word_chars"))}).drop(w, each)
