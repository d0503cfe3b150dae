"""Markup to text, in expressions: tags with quoted attributes, and all character references."""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltworks.functions.binding import let

# Fixed patterns: what is never shown, a tag whose quoted attributes may hold any
# character, and what is left of tags with an open quote.
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
TAG = r"""<[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+>"""
REST = r"(?s)<[^>]*>"
SPACE = r"[\s\x{A0}]+"
#: a reference at the start of what follows an ampersand
_REFERENCE = r"^(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]*);"
_LAST = 0x10FFFF


@cache
def references() -> str:
    """Names, and the numbers that stand for other characters than their own, as a JSON object.

    Names are the standard's; numbers 128 to 159 mean the Windows code page.
    """
    names = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    for n in range(128, 160):
        try:
            names[f"#{n}"] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:  # five numbers have no character there
            names[f"#{n}"] = chr(n)
    return json.dumps(names)


def _character(number: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    real = number.between(1, _LAST) & ~number.between(0xD800, 0xDFFF)
    coded = F.decode(F.unhex(F.lpad(F.hex(F.when(real, number).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    return coded


def _decoded(part: Column, names: Column) -> Column:
    """What follows an ampersand, with its reference decoded if it is one."""

    def known(name: Column) -> Column:
        hexadecimal = name.rlike("^#[xX]")
        number = F.when(hexadecimal, F.conv(F.substr(name, F.lit(3)), 16, 10)).when(name.startswith("#"), F.substr(name, F.lit(2))).cast("long")

        def text(n: Column) -> Column:
            listed = F.element_at(names, F.when(n.isNull(), name).when(n.between(128, 159), F.concat(F.lit("#"), n.cast("string"))))
            return F.coalesce(listed, F.when(n.isNotNull(), _character(n)))

        found = let(number, text)
        return F.when((name != "") & found.isNotNull(), F.concat(found, F.substr(part, F.length(name) + 2))).otherwise(F.concat(F.lit("&"), part))

    return let(F.regexp_extract(part, _REFERENCE, 1), known)


def decode_references(text: Column) -> Column:
    """``&name;``, ``&#10;`` and ``&#xA;`` to characters, each once; anything else stays as it is."""
    names = F.from_json(F.lit(references()), "map<string,string>")

    def joined(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: _decoded(p, names))
        return F.concat(parts[0], F.array_join(rest, ""))

    return F.when(text.contains("&"), let(F.split(text, "&", -1), joined)).otherwise(text)


def visible_text(html: Column) -> Column:
    """Markup to text: script and style bodies, comments and tags go, references are decoded, white space is single."""
    body = F.regexp_replace(html, HIDDEN, " ")
    bare = F.regexp_replace(F.regexp_replace(body, TAG, " "), REST, " ")
    return F.trim(F.regexp_replace(let(bare, decode_references), SPACE, " "))
