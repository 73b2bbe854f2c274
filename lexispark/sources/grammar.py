"""Element lists from a RELAX NG grammar in XML syntax: which elements hold text, chunks, paragraphs, or nothing."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Iterator

RNG = "{http://relaxng.org/ns/structure/1.0}"


class Grammar:
    def __init__(self, xml: str | bytes) -> None:
        self.root = ET.fromstring(xml)
        self.defines: dict[str, list[ET.Element]] = {}
        for d in self.root.iter(f"{RNG}define"):
            self.defines.setdefault(d.get("name", ""), []).append(d)
        self.elements = list(self.root.iter(f"{RNG}element"))

    def reached(self, patterns: list[ET.Element]) -> Iterator[ET.Element]:
        """Patterns below these, references followed once, without what stands inside elements and attributes."""
        seen: set[str] = set()
        todo = [c for p in patterns for c in p][::-1]
        while todo:
            p = todo.pop()
            kind = p.tag.removeprefix(RNG)
            if kind == "ref":
                if (name := p.get("name", "")) not in seen:
                    seen.add(name)
                    todo += [c for d in self.defines.get(name, []) for c in d][::-1]
                continue
            yield p
            if kind not in ("element", "attribute"):
                todo += list(p)[::-1]

    def names(self, element: ET.Element) -> set[str]:
        if element.get("name"):
            return {element.get("name", "").rpartition(":")[2]}
        return {(n.text or "").strip().rpartition(":")[2] for n in element.iter(f"{RNG}name")}

    def model(self, name: str) -> list[ET.Element]:
        return [p for p in self.reached(self.defines.get(name, [])) if p.tag == f"{RNG}element"]

    def content(self, element: ET.Element) -> set[str]:
        groups = {"group", "choice", "interleave", "optional", "zeroOrMore", "oneOrMore", "mixed", "list", "name", "anyName", "nsName", "except", "grammar", "div", "notAllowed"}
        kinds = {p.tag.removeprefix(RNG) for p in self.reached([element]) if p.tag.startswith(RNG)}
        return (kinds - groups) | ({"text"} if "mixed" in kinds else set())

    def categories(self) -> dict[str, list[str]]:
        """Sorted local names by category: containers, milestones, chunks, paras."""
        gather = lambda *models: {n for m in models for e in self.model(m) for n in self.names(e)}
        declared = {n for e in self.elements for n in self.names(e)}
        return {
            "containers": sorted({n for e in self.elements if self.content(e) <= {"element", "attribute", "empty"} for n in self.names(e)}),
            "milestones": sorted({n for e in self.model("model.milestoneLike") if self.content(e) <= {"attribute", "empty"} for n in self.names(e)}),
            "chunks": sorted(gather("model.divTop", "model.divBottom", "model.common") - gather("model.oddDecl", "model.egLike")),
            "paras": sorted(gather("model.lLike", "model.pLike") | (declared & {"headItem", "headLabel", "item", "label", "row"})),
        }

    def to_json(self) -> str:
        return json.dumps(self.categories())
