"""RDF/XML and Turtle texts as triples. A file is parsed as a whole, for neither syntax can be cut at lines."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa

Triple = tuple[str, str, str, bool, str | None]
# Names of the RDF vocabulary.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XML = "{http://www.w3.org/XML/1998/namespace}"
TYPE, FIRST, REST, NIL = f"{RDF}type", f"{RDF}first", f"{RDF}rest", f"{RDF}nil"


def _name(tag: str) -> str:
    return tag.removeprefix("{").replace("}", "", 1)


class XmlTriples:
    """Triples of one RDF/XML text: typed nodes, nested nodes, attributes as properties, blank nodes, languages, resource types of properties."""

    def __init__(self, text: bytes, source: str) -> None:
        self.found: list[Triple] = []
        self.source, self.blanks = source, 0
        root = ElementTree.fromstring(text)
        nodes = list(root) if root.tag == f"{{{RDF}}}RDF" else [root]
        for n in nodes:
            self._node(n, root.get(f"{XML}lang"), root.get(f"{XML}base", ""))

    def _blank(self, label: str | None = None) -> str:
        self.blanks += label is None
        return f"_:{label or f'b{self.blanks}'}"

    def _node(self, e: ElementTree.Element, lang: str | None, base: str) -> str:
        lang, base = e.get(f"{XML}lang", lang), e.get(f"{XML}base", base)
        own = {_name(k): v for k, v in e.attrib.items() if not k.startswith(XML)}
        about, ident = own.pop(f"{RDF}about", None), own.pop(f"{RDF}ID", None)
        label = own.pop(f"{RDF}nodeID", None)
        s = about if about and ":" in about else base + (about or "") if about is not None else f"{base}#{ident}" if ident else self._blank(label)
        if _name(e.tag) != f"{RDF}Description":
            self.found.append((s, TYPE, _name(e.tag), False, None))
        for p, value in own.items():
            self.found.append((s, p, value, p != TYPE, None if p == TYPE else lang))
        for child in e:
            self._property(s, child, lang, base)
        return s

    def _property(self, s: str, e: ElementTree.Element, lang: str | None, base: str) -> None:
        lang, p = e.get(f"{XML}lang", lang), _name(e.tag)
        own = {_name(k): v for k, v in e.attrib.items() if not k.startswith(XML)}
        if (r := own.get(f"{RDF}resource")) is not None:
            self.found.append((s, p, r if ":" in r else base + r, False, None))
        elif (label := own.get(f"{RDF}nodeID")) is not None:
            self.found.append((s, p, self._blank(label), False, None))
        elif own.get(f"{RDF}parseType") == "Resource":
            o = self._blank()
            self.found.append((s, p, o, False, None))
            for child in e:
                self._property(o, child, lang, base)
        elif own.get(f"{RDF}parseType") == "Collection":
            items = [self._node(c, lang, base) for c in e]
            cells = [self._blank() for _ in items]
            self.found.append((s, p, cells[0] if cells else NIL, False, None))
            for k, (cell, item) in enumerate(zip(cells, items, strict=True)):
                self.found += [(cell, FIRST, item, False, None), (cell, REST, cells[k + 1] if k + 1 < len(cells) else NIL, False, None)]
        elif len(e):
            for child in e:
                self.found.append((s, p, self._node(child, lang, base), False, None))
        else:
            self.found.append((s, p, e.text or "", True, None if f"{RDF}datatype" in own else lang))


_TOKEN = re.compile(
    r"""(?P<space>\s+|\#[^\n]*)|(?P<uri><[^<>]*>)|(?P<long>\"{3}(?:[^"\\]|\\.|"(?!""))*\"{3}|'{3}(?:[^'\\]|\\.|'(?!''))*'{3})
    |(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<at>@[A-Za-z][A-Za-z0-9-]*)|(?P<type>\^\^)|(?P<blank>_:[^\s;,.()\[\]]+)
    |(?P<number>[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?(?![\w:]))|(?P<name>[^\s;,()\[\]<>"':]*:(?:[^\s;,.()\[\]<>"']|\.(?=[^\s;,()\[\]<>"']))*)|(?P<word>[A-Za-z]+)|(?P<mark>[;,.()\[\]])""",
    re.VERBOSE | re.DOTALL,
)
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.DOTALL)
_CODES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}


def _unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _CODES.get(m[1], m[1]), text)


class TurtleTriples:
    """Triples of one Turtle text: prefixes, bases, lists of predicates and objects, nested blank nodes, collections, all kinds of literals."""

    def __init__(self, text: str, source: str) -> None:
        self.found: list[Triple] = []
        self.prefixes: dict[str, str] = {}
        self.base, self.source, self.blanks = "", source, 0
        self.tokens = list(self._tokens(text))
        self.at = 0
        while self.at < len(self.tokens):
            self._statement()

    def _tokens(self, text: str) -> Iterator[tuple[str, str]]:
        at = 0
        while at < len(text):
            if not (m := _TOKEN.match(text, at)):
                raise ValueError(f"{self.source}: no Turtle at {text[at : at + 40]!r}")
            if m.lastgroup != "space":
                yield str(m.lastgroup), m[0]
            at = m.end()

    def _next(self) -> tuple[str, str]:
        if self.at >= len(self.tokens):
            raise ValueError(f"{self.source}: ends within a statement")
        self.at += 1
        return self.tokens[self.at - 1]

    def _peek(self) -> str:
        return self.tokens[self.at][1] if self.at < len(self.tokens) else ""

    def _expect(self, mark: str) -> None:
        if (got := self._next()[1]) != mark:
            raise ValueError(f"{self.source}: {mark} expected, not {got!r}")

    def _uri(self, kind: str, token: str) -> str:
        if kind == "uri":
            return token[1:-1] if ":" in token else self.base + token[1:-1]
        prefix, local = token.split(":", 1)
        return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    def _statement(self) -> None:
        kind, token = self.tokens[self.at]
        if token.lower() in ("@prefix", "prefix", "@base", "base") and kind in ("at", "word"):
            self.at += 1
            prefix = self._next()[1][:-1] if "prefix" in token.lower() else None
            uri = self._next()[1][1:-1]
            if prefix is None:
                self.base = uri
            else:
                self.prefixes[prefix] = uri if ":" in uri else self.base + uri
            if kind == "at":
                self._expect(".")
            return
        s, _, _ = self._object()
        if self._peek() != ".":
            self._predicates(s)
        self._expect(".")

    def _predicates(self, s: str) -> None:
        while True:
            kind, token = self._next()
            p = TYPE if (kind, token) == ("word", "a") else self._uri(kind, token)
            while True:
                o, literal, lang = self._object()
                self.found.append((s, p, o, literal, lang))
                if self._peek() != ",":
                    break
                self.at += 1
            while self._peek() == ";":
                self.at += 1
            if self._peek() in (".", "]", ""):
                return

    def _blank(self) -> str:
        self.blanks += 1
        return f"_:b{self.blanks}"

    def _object(self) -> tuple[str, bool, str | None]:
        kind, token = self._next()
        if kind in ("uri", "name"):
            return self._uri(kind, token), False, None
        if kind == "blank":
            return token, False, None
        if kind in ("text", "long"):
            value, lang = _unescaped(token[3:-3] if kind == "long" else token[1:-1]), None
            if self.at < len(self.tokens) and self.tokens[self.at][0] == "at":
                lang = self._next()[1][1:]
            elif self._peek() == "^^":
                self.at += 2
            return value, True, lang
        if kind == "number" or (kind == "word" and token in ("true", "false")):
            return token, True, None
        if token == "[":
            s = self._blank()
            if self._peek() != "]":
                self._predicates(s)
            self._expect("]")
            return s, False, None
        if token == "(":
            items = []
            while self._peek() != ")":
                items.append(self._object())
            self.at += 1
            cells = [self._blank() for _ in items]
            for k, (cell, item) in enumerate(zip(cells, items, strict=True)):
                self.found += [(cell, FIRST, *item), (cell, REST, cells[k + 1] if k + 1 < len(cells) else NIL, False, None)]
            return (cells[0] if cells else NIL), False, None
        raise ValueError(f"{self.source}: {token!r} is no subject or object")


def parsed(batches: Iterator[pa.RecordBatch], syntax: str | None) -> Iterator[pa.RecordBatch]:
    """Triples of files (path, content); blank nodes carry a mark of their file."""
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
            kind = syntax or ("xml" if path.lower().endswith((".rdf", ".xml", ".owl")) else "turtle")
            found = XmlTriples(content, path).found if kind == "xml" else TurtleTriples(content.decode(), path).found
            mark = f"{hash_of(path):x}"
            own = lambda x: f"_:{mark}{x[2:]}" if x.startswith("_:") else x  # noqa: B023, E731
            rows = [(own(s), p, o if literal else own(o), literal, lang) for s, p, o, literal, lang in found]
            columns = list(zip(*rows, strict=True)) or [(), (), (), (), ()]
            kinds = (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["s", "p", "o", "o_is_literal", "o_lang"])


def hash_of(path: str) -> int:
    """A number that is the same for a path in every process."""
    out = 0xCBF29CE484222325
    for byte in path.encode():
        out = (out ^ byte) * 0x100000001B3 % (1 << 64)
    return out
