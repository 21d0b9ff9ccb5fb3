"""Licence templates inside longer lines, paragraphs and texts."""

from jobloom.llm import license_scan

PROSE = "some other words that tell of a quite different matter in the town " * 30
MIT = license_scan.TEMPLATES[2][1]


def _found(text):
    return [(m.licence, m.dice) for m in license_scan.Templates().scan(text)]


def test_a_template_is_found_wherever_it_stands():
    assert _found(f"{MIT}\n\n{PROSE}\n{PROSE}") == [("MIT", 1.0)]
    assert _found(f"{PROSE} Released under the MIT License. {PROSE}") == [("MIT", 1.0)]
    assert _found(f"{PROSE}\nReleased under\nthe MIT License.\n{PROSE}") == [("MIT", 1.0)]
    commented = "\n".join(f"# {line}" for line in MIT.split("\n"))
    assert _found(f"{PROSE}\n{commented}\n{PROSE}") == [("MIT", 1.0)]
    assert _found(PROSE) == []


def test_places_that_do_not_overlap_count_once_each():
    text = f"Released under the MIT License. {PROSE} Licensed under CC BY 4.0. {PROSE}"
    assert sorted(_found(text)) == [("CC-BY-4.0", 1.0), ("MIT", 1.0)]
    assert _found("Released under the MIT License.") == [("MIT", 1.0)]
