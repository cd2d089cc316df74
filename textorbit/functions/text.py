"""Column expressions that clean raw posts.

Everything here is a JVM-side expression; nothing leaves whole-stage codegen's reach
for Python. The character class ``SPACE`` spells out what "white space" means for
Unicode text, because the regex engine's own ``\\s`` only covers ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white-space code points of Unicode text, plus the four ASCII
# separators \x1c-\x1f, written so that they can stand inside a character class.
SPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS = f"[{SPACE}]"
NON_WS = f"[^{SPACE}]"
# Runs of white space other than one blank. Most characters fail the first test, one range.
WIDE_WS = rf"(?![!-~])(?: {WS}+|[{SPACE.replace('x20', 'x1f')}]{WS}*)"

# The noise patterns of a news post. (?d) makes \n the only line end.
SUBJECT_LINE = rf"(?dimu)^Subject:{WS}*(.+)$"
REPLY_PREFIX = rf"(?iu)^(Re|Fwd|Fw):{WS}*"
SIGNATURE = rf"(?s)\n--{WS}*\n.*"
QUOTED_LINE = r"(?dm)^>.*$"
URL = rf"https?://{NON_WS}+|www\.{NON_WS}+"
# An address takes its whole word, so it is matched from the word's start and at the
# word's first usable @: same matches as NON_WS+@NON_WS+\.NON_WS+, in linear time.
EMAIL = rf"(?<!{NON_WS}){NON_WS}[^@{SPACE}]*+@{NON_WS}+\.{NON_WS}+"
HEADER_LINE = r"(?dm)^[A-Za-z\-]+:.*$"


def strip_space(text: Column) -> Column:
    """Trim Unicode white space on both sides (``trim`` only knows blanks)."""
    return F.regexp_replace(text, rf"^{WS}+|{WS}+\z", "")


def unix_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def post_subject(raw: Column, strip_chain: bool = False) -> Column:
    """Subject of a post without its reply prefix; empty when there is none.

    One prefix is removed; ``strip_chain`` removes a whole ``Re: Re: Fwd:`` chain.
    """
    prefix = rf"(?iu)^((Re|Fwd|Fw):{WS}*)+" if strip_chain else REPLY_PREFIX
    line = strip_space(F.regexp_extract(raw, SUBJECT_LINE, 1))
    return strip_space(F.regexp_replace(line, prefix, ""))


def post_body(raw: Column) -> Column:
    """Text after the first blank line (all of it if there is none)."""
    return F.element_at(F.split(raw, "\n\n", 2), -1)


def without_trailer(body: Column) -> Column:
    """Drop the signature, then quoted lines, then URLs."""
    body = F.regexp_replace(body, SIGNATURE, "")
    body = F.regexp_replace(body, QUOTED_LINE, "")
    return F.regexp_replace(body, URL, " ")


def without_addresses(body: Column) -> Column:
    """Drop e-mail addresses; the test spares most rows the costlier pattern."""
    return F.when(body.contains("@"), F.regexp_replace(body, EMAIL, " ")).otherwise(body)


def flattened(body: Column) -> Column:
    """Drop left-over header lines and collapse white space."""
    body = F.regexp_replace(body, HEADER_LINE, " ")
    return F.trim(F.regexp_replace(body, WIDE_WS, " "))


def boosted_text(subject: Column, body: Column) -> Column:
    """The body, led by the subject twice when there is one."""
    return F.when(subject != "", F.concat_ws(" ", subject, subject, body)).otherwise(body)


def token_count(text: Column) -> Column:
    """Number of white-space separated tokens."""
    bare = strip_space(text)
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, rf"{WS}+")))


def flat_token_count(flat: Column) -> Column:
    """``token_count`` of text whose white space is collapsed: blanks plus one."""
    blanks = F.octet_length(flat) - F.octet_length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(flat == "", 0).otherwise(blanks + 1)


def content_id(text: Column) -> Column:
    """Identity of a document: 16 hex digits of the SHA-256 of its text."""
    return F.substring(F.sha2(text, 256), 1, 16)


def preview(text: Column, n_chars: int) -> Column:
    return F.coalesce(F.substring(text, 1, n_chars), F.lit(""))
