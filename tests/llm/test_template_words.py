from __future__ import annotations

import random

import xxhash

from pitlane.llm import decontaminate as D


class Counted(dict):
    gets = 0

    def get(self, *args):
        Counted.gets += 1
        return super().get(*args)


def by_word(text: str) -> list[tuple[str, str, bool]]:
    """Template word, own word and whether it is a slot, one word after another."""
    out = []
    for line in text.split("\n"):
        begins, before = True, None
        for chunk in line.split():
            parts = [chunk] if chunk.isalpha() else D._PART.findall(chunk)
            for nth, part in enumerate(parts):
                number = part[0].isdigit()
                own = part if number else part.lower()
                title = not number and len(part) > 1 and part[0].isupper() and part[1:].islower()
                if title and not (nth == 0 and begins):
                    template = D.NAME
                elif not number and own in D.UNITS and before:
                    template = D.UNIT
                else:
                    template = D.NUM if number else own
                out.append((template, own, template in (D.NAME, D.UNIT, D.NUM)))
                before = number
            if D._STOP.search(chunk):
                begins = True
            elif parts:
                begins = False
    return out


def test_template_words_equal_those_found_one_by_one():
    draw = random.Random(8)
    chunks = ["Anna", "runs", "5", "km", "12.5", "kg,", "A", "McDonald", "end.", "--", "(Paris)", "3km", "\u00b2", "x2y", "why?\"",
              "Stra\u00dfe", "...", "no_w", "Lyon;", "m", "Mile", "\u4e2d\u6587", "e-Mail", "7", "Oslo:"]
    templates = D.Templates()
    for _ in range(400):
        text = "".join(draw.choice(chunks) + draw.choice([" ", " ", " ", "\n", "  "]) for _ in range(draw.randrange(25)))
        codes, words, slot = templates.of(text)
        found = [(int(c), words[i], bool(s)) for i, (c, s) in enumerate(zip(codes, slot, strict=True))]
        assert found == [(xxhash.xxh64_intdigest(t), own, s) for t, own, s in by_word(text)], text


def test_each_chunk_is_looked_up_once_though_some_are_new():
    templates = D.Templates()
    templates.ids = Counted()
    templates.of("one two three four")
    assert Counted.gets == 4
    templates.of("one two three five")
    assert Counted.gets == 8
