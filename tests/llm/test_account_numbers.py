"""Account numbers followed by capitals, digits or other numbers."""

import pytest

from tidewatch.llm import pii

GB, DE = "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"


def numbers(text):
    return [text[start:end] for kind, start, end, _ in pii.find_spans(text) if kind == "iban"]


@pytest.mark.parametrize("number", [GB, GB.replace(" ", ""), DE, "NO9386011117947", "AO06004400006729503010102"])
@pytest.mark.parametrize("after", ["", ".", " is mine", " BIC NWBKGB2L", " BIC: X", " I owe", " 5 days", " 2024 A 7 B", " Bank", "\nBIC", " BIC NWBKGB2L XX12 3456"])
def test_what_follows_is_left_out(number, after):
    text = f"IBAN {number}{after}"
    assert numbers(text) == [number]
    assert pii.redacted(text, pii.find_spans(text)) == f"IBAN [IBAN]{after}"


def test_numbers_after_one_another_and_after_a_failed_one():
    assert numbers(f"{GB} {DE} {GB}") == [GB, DE, GB]
    assert numbers(f"XX99 A1 {GB} BIC") == [GB]


def test_what_is_none():
    for text in (GB[:-1] + "3 BIC", GB.replace(" ", "") + "X", "x" + DE, DE + "a", DE[:-1], "GB82 " * 5000, "GB82", "GB82 "):
        assert numbers(text) == [], text[:40]
