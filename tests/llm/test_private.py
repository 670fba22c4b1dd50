"""What op3 must find, must leave, and must live through."""

import ipaddress
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dockhand.llm import pii

CHANGE = pii.permutation(b"sixteen bytes :)")
ODD = "0123456789١٢٣４５６²½Ⅷ+-./() @=:AZazßİ\n\x00"


def hidden(text):
    return pii.apply(text, pii.find(text, CHANGE))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ODD, max_size=60) | st.text(max_size=40))
def test_no_text_ends_the_job(text):
    found = pii.find(text, CHANGE)
    ends = [0] + [b for _, _, b, _ in found]
    assert all(a >= before and a < b <= len(text) for before, (_, a, b, _) in zip(ends, found, strict=False))
    assert len(hidden(text)) >= 0


@pytest.mark.parametrize("text,kind", [
    ("password=correcthorsebattery", "secret"), ("pwd: P@ssw0rd123.", "secret"), ("API_KEY = 'aZ09+/aZ09+/'", "secret"),
    ("ghp_abcdefghijklmnopqrstuvwxyz0123456789", "access_token"), ("jürgen.müller@example.org", "email"),
    ("host 2001:db8::ff00:42:8329 is up", "ipv6"), ("4111１１１１１１１１１１１1", "card"), ("４１１１１１１１１１１１１１１１", "card"),
])
def test_found_in_each_form(text, kind):
    assert [k for k, *_ in pii.find(text, CHANGE)] == [kind]
    assert hidden(text) != text


@pytest.mark.parametrize("text", [
    "the secret: everything is prose", "token=abc", "12:30:45 and ::1", "a::b is no address of ours :: here", "4111111111111112", "²²²²-²²-²²²² Ⅷ",
])
def test_left_alone(text):
    assert hidden(text) == text


def test_wide_addresses_are_permuted_among_themselves():
    every = {hidden(f"2001:db8::{i:x}") for i in range(1, 500)}
    assert len(every) == 499 and all(ipaddress.IPv6Address(x) for x in every)
    assert hidden("2001:DB8:0:0::7") == hidden("2001:db8::7")


def test_time_is_linear_in_the_values():
    def seconds(n):
        text = " ".join(["password=abcdefgh12345", "4111 1111 1111 1111"][i % 2] for i in range(n))
        start = time.perf_counter()
        assert len(pii.find(text, CHANGE)) == n
        return time.perf_counter() - start

    seconds(200)
    assert seconds(8000) < 12 * seconds(2000)


def test_spans_against_a_plain_version():
    spans = [(5, 9), (7, 12), (20, 21), (30, 40), (33, 35)]
    found = pii._Spans(spans)
    for a in range(45):
        for b in range(a + 1, 46):
            assert found.meets(a, b) == any(x < b and a < y for x, y in spans)


def test_formats_stay_valid():
    new = hidden("call 212-555-0100, card 4111 1111 1111 1111, ssn 123-45-6789, on 2024-01-31")
    assert re.fullmatch(r"call [0-9]{3}-[0-9]{3}-[0-9]{4}, card 4[0-9]{3}( [0-9]{4}){3}, ssn [0-9]{3}-[0-9]{2}-[0-9]{4}, on (19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}", new)
    digits = re.search(r"card ([0-9 ]+)", new)[1].replace(" ", "")
    assert pii.luhn(digits[:-1]) == int(digits[-1])
