"""Quality rules, line first: bad lines go, then documents that lost too much.

Every line is judged by itself (punctuation, navigation, boilerplate). Failing
lines are removed, and a document goes if the removed share of its word
characters exceeds ``max_lost``, or if it fails the base rules on length and
repetition. The rules read the whole text; one pass, no shuffle.

Defined results: a null text counts as no words (base_failed, not kept, cleaned
text null); blank lines are neutral; a column of the input that has the name of
a computed one is replaced in ``score``, and kept as it is in
``filter_documents``, which returns the input's own columns only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import arrow_map, bounded_batches, private

MIN_WORDS = 50
#: A document goes if more than this percentage of its words lies in repeated 3-word windows.
MAX_REPEAT_PERCENT = 50
#: A document goes if its failing lines hold more than this percentage of its word characters.
MAX_LOST_PERCENT = 30
#: A line fails if symbols are more than this percentage of its word characters,
MAX_SYMBOL_PERCENT = 10
#: or exclamation and question marks outnumber its words, or if at least so many of its words are bare separators,
MIN_SEPARATORS = 3
#: or if it has fewer words than this and no sentence mark at its end (a menu entry),
MIN_OPEN_WORDS = 4
SYMBOLS = "#*$%&|<>"
SEPARATORS = ["|", ">", "»", "›", "•", "·", "/", "-", "–", "::"]
END_MARK = r"[.!?…:;,。！？][\"'”’»)\]]*$"
#: or if it is short and holds one of these phrases (lower case; A-Z of a line are lower-cased, no other letters).
BOILERPLATE = [
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "enable javascript", "javascript is disabled", "click here", "sign in", "log in", "subscribe to our newsletter",
    "lorem ipsum", "page not found", "skip to content", "share this", "read more",
    "alle rechte vorbehalten", "cookies akzeptieren", "datenschutzerklärung", "nutzungsbedingungen", "javascript aktivieren",
    "hier klicken", "jetzt anmelden", "newsletter abonnieren", "seite nicht gefunden", "zum inhalt springen", "weiterlesen",
    "tous droits réservés", "accepter les cookies", "politique de confidentialité", "conditions d'utilisation", "mentions légales",
    "activer javascript", "cliquez ici", "se connecter", "abonnez-vous à notre newsletter", "page introuvable", "aller au contenu", "lire la suite",
    "todos los derechos reservados", "aceptar cookies", "política de privacidad", "política de cookies", "términos de uso", "condiciones de uso",
    "habilitar javascript", "haga clic aquí", "iniciar sesión", "suscríbete a nuestro boletín", "página no encontrada", "saltar al contenido", "leer más",
]
MAX_BOILERPLATE_WORDS = 25

SCHEMA = T.StructType(
    [
        T.StructField(n, T.LongType())
        for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines", "lost_chars")
    ]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("clean_text", T.StringType())]
)

_SPACE = b" \t\n\r\x0b\f"
_SYMBOL = re.compile(b"[" + re.escape(SYMBOLS.encode()) + b"]")
_MARKS = re.compile(rb"[!?]")
_END = re.compile(END_MARK)
_PHRASE = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())
_SEPARATORS = {s.encode() for s in SEPARATORS}


def line_fails(line: bytes, words: list[bytes], chars: int) -> bool:
    """Whether a line that has words breaks one of the line rules."""
    n = len(words)
    if len(_SYMBOL.findall(line)) * 100 > MAX_SYMBOL_PERCENT * chars:
        return True
    if (b"!" in line or b"?" in line) and len(_MARKS.findall(line)) > n:
        return True
    if n >= MIN_SEPARATORS and sum(w in _SEPARATORS for w in words) >= MIN_SEPARATORS:
        return True
    if n < MIN_OPEN_WORDS and not _END.search(words[-1].decode()):
        return True
    return n <= MAX_BOILERPLATE_WORDS and bool(_PHRASE.search(line.lower()))


def repeated_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(windows) < 2:
        return 0
    once, again = set(), set()
    for w in windows:
        if w in once:
            again.add(w)
        else:
            once.add(w)
    if not again:
        return 0
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if w in again:
            covered += i + 3 - max(end, i)
            end = i + 3
    return covered


def judge(text: bytes | None) -> tuple:
    """The values of SCHEMA for one text."""
    if text is None:
        return 0, 0, 0, 0, 0, 0, 0, True, False, None
    words: list[bytes] = []
    seen: set[bytes] = set()
    good: list[bytes] = []
    chars = lost = duplicates = bad = 0
    for line in text.split(b"\n"):
        own = line.split()
        if not own:
            good.append(line)
            continue
        if line in seen:
            duplicates += 1
        else:
            seen.add(line)
        size = len(b"".join(own).decode())
        chars += size
        words += own
        if line_fails(line, own, size):
            bad += 1
            lost += size
        else:
            good.append(line)
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    kept = not failed and 100 * lost <= MAX_LOST_PERCENT * chars
    return len(words), chars, len(_SYMBOL.findall(text)), duplicates, repeats, bad, lost, failed, kept, b"\n".join(good).decode()


def _judge_all(column: list[bytes | None]) -> dict[str, list]:
    found = list(zip(*map(judge, column), strict=True)) or [()] * len(SCHEMA)
    return {f.name: list(v) for f, v in zip(SCHEMA, found, strict=True)}


def score(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the columns of SCHEMA appended."""
    bounded_batches(df.sparkSession)
    return arrow_map(df, [text], SCHEMA, _judge_all)


def filter_documents(df: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The documents that pass, with their failing lines removed; the columns of df."""
    names = private(df, *(f.name for f in SCHEMA))
    schema = T.StructType([T.StructField(names[f.name], f.dataType) for f in SCHEMA])

    def run(column: list[bytes | None]) -> dict[str, list]:
        return {names[k]: v for k, v in _judge_all(column).items()}

    bounded_batches(df.sparkSession)
    kept = arrow_map(df, [text], schema, run).filter(F.col(names["kept"]))

    def cell(c: str) -> Column:
        if c == text:
            return F.col(names["clean_text"]).alias(c)
        if c == n_chars:
            return F.length(names["clean_text"]).cast(df.schema[c].dataType).alias(c)
        return F.col(c)

    return kept.select(*(cell(c) for c in df.columns))


_WS = r"\x20\x09-\x0D"
_SQL_PHRASES = "|".join(p.replace("'", "''") for p in BOILERPLATE)
_SQL_SEPARATORS = ", ".join(f"'{s}'" for s in SEPARATORS)
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents
), parts AS (
  SELECT doc_id, i, line, regexp_extract_all(line, '[^{_WS}]+') AS w, length(regexp_replace(line, '[{_WS}]', '', 'g')) AS chars,
         row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS nth
  FROM lines WHERE regexp_matches(line, '[^{_WS}]')
), judged AS (
  SELECT *, (length(line) - length(regexp_replace(line, '[{SYMBOLS}]', '', 'g'))) AS symbols,
    length(line) - length(regexp_replace(line, '[!?]', '', 'g')) AS marks,
    len(list_filter(w, lambda x: x IN ({_SQL_SEPARATORS}))) AS seps,
    regexp_matches(w[-1], '{END_MARK.replace("'", "''")}') AS ended,
    regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SQL_PHRASES}') AS boiler
  FROM parts
), per_doc AS (
  SELECT doc_id, sum(len(w)) AS n_words, sum(chars) AS word_chars, sum((nth > 1)::INT) AS n_dup_lines, sum(symbols) AS n_symbols,
    sum(CASE WHEN symbols * 100 > {MAX_SYMBOL_PERCENT} * chars OR marks > len(w) OR (len(w) >= {MIN_SEPARATORS} AND seps >= {MIN_SEPARATORS})
      OR (len(w) < {MIN_OPEN_WORDS} AND NOT ended) OR (len(w) <= {MAX_BOILERPLATE_WORDS} AND boiler) THEN chars ELSE 0 END) AS lost_chars
  FROM judged GROUP BY doc_id
), words AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[^{_WS}]+')) AS w, unnest(range(len(regexp_extract_all(text, '[^{_WS}]+')))) AS i FROM documents
), windows AS (
  SELECT * FROM (SELECT doc_id, i, w AS a, lead(w) OVER o AS b, lead(w, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE c IS NOT NULL
), repeats AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM repeats) GROUP BY doc_id
), counted AS (
  SELECT d.doc_id, coalesce(p.n_words, 0)::BIGINT AS n_words, coalesce(p.word_chars, 0)::BIGINT AS word_chars,
    coalesce(p.n_symbols, 0)::BIGINT AS n_symbols, coalesce(p.n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(p.lost_chars, 0)::BIGINT AS lost_chars
  FROM documents d LEFT JOIN per_doc p USING (doc_id) LEFT JOIN covered c USING (doc_id)
)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND 100 * lost_chars <= {MAX_LOST_PERCENT} * word_chars AS kept
FROM counted
"""
