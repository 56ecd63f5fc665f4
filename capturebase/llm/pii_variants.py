"""Personal data as it is written where patterns miss it, and numbers that are no personal data, for training."""

from __future__ import annotations

import re

import numpy as np


def _digits(g: np.random.Generator, n: int, first: int = 1) -> str:
    return str(g.integers(first, 10)) + "".join(map(str, g.integers(0, 10, n - 1)))


def _name(g: np.random.Generator, least: int = 2, most: int = 9) -> str:
    return "".join(chr(97 + k) for k in g.integers(0, 26, g.integers(least, most + 1)))


def _luhn(body: str) -> str:
    """The number with its check digit."""
    total = 0
    for i, c in enumerate(reversed(body)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 * (n > 9)
    return body + str(-total % 10)


def _email(g: np.random.Generator, given: str | None) -> str:
    local, _, domain = (given or "").partition("@")
    local = local or _name(g) + str(g.choice(["", ".", "_", "-"])) + _name(g) + str(g.choice(["", str(g.integers(0, 100))]))
    domain = domain or _name(g, 3) + "." + str(g.choice(["com", "org", "net", "example.com", "de", "co.uk", "fr", "es"]))
    at = str(g.choice([" (at) ", "(at)", " [at] ", "[at]", " {at} ", " at ", " AT ", " @ ", "@", " <at> "]))
    dots = [" dot ", " DOT "] if at.strip().lower() == "at" else [" [dot] "] if "[" in at else [" (dot) ", "(dot)", ".", "."]
    dot = str(g.choice([*dots, *([] if at == "@" or at.strip().lower() == "at" else ["."])]))
    if at == "@" and dot == ".":
        dot = "(dot)"
    return local.rstrip(".") + at + domain.replace(".", dot)


def _ip(g: np.random.Generator, given: str | None) -> str:
    four = (given or ".".join(str(g.integers(0, 256)) for _ in range(4))).split(".")
    return str(g.choice(["[.]", "(.)", " . ", "{.}"])).join(four)


def _card(g: np.random.Generator, given: str | None) -> str:
    digits = re.sub(r"[^0-9]", "", given or "") or _luhn(str(g.choice(["4", "51", "34", "6011"])) + _digits(g, 11, 0))
    if len(digits) < 13:
        digits = _luhn(digits + _digits(g, 15 - len(digits), 0))
    return str(g.choice([".", "_", "/", "  ", " - ", "."])).join(digits[i : i + 4] for i in range(0, len(digits), 4))


def _phone(g: np.random.Generator, given: str | None) -> str:
    d = re.sub(r"[^0-9]", "", given or "")
    area, mid, end = (d[-10:-7], d[-7:-4], d[-4:]) if len(d) >= 10 else (_digits(g, 3, 2), _digits(g, 3, 2), _digits(g, 4, 0))
    country, town = str(g.integers(20, 99)), _digits(g, int(g.integers(2, 5)))
    rest = _digits(g, int(g.integers(6, 8)))
    forms = [
        f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"{area} {mid} {end}", f"1-{area}-{mid}-{end}", f"({area}){mid}-{end}", f"1 ({area}) {mid}-{end}",
        f"00{country} {town} {rest}", f"0{town} {rest}", f"0{town}/{rest}", f"0{town}-{rest}", f"(0{town}) {rest}", f"00{country}-{town}-{rest}",
    ]
    return str(g.choice(forms))


def variant(kind: int, g: np.random.Generator, given: str | None = None) -> str:
    """An email address, IP address, card or phone number in a form that the patterns don't know; ``given`` is what to write, else it is invented."""
    return (_email, _ip, _card, _phone)[kind](g, given)


def others(g: np.random.Generator) -> str:
    """A day, time, version, order, price, range or page, or words with at and dot: no personal data."""
    n = lambda a, b: int(g.integers(a, b))
    y, m, d = n(1900, 2100), n(1, 13), n(1, 29)
    forms = [
        f"{y}-{m:02d}-{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{m}/{d}/{y}", f"{y}/{m:02d}/{d:02d} {n(0, 24):02d}:{n(0, 60):02d}:{n(0, 60):02d}", f"{d}.{m}.{y % 100:02d}", f"{n(0, 24)}:{n(0, 60):02d}",
        f"v{n(0, 20)}.{n(0, 20)}.{n(0, 20)}", f"version {n(0, 20)}.{n(0, 100)}", f"order {_digits(g, 3)}-{_digits(g, 4)}-{_digits(g, 2)}", f"No. {_digits(g, 4)}-{_digits(g, 2)}", f"#{_digits(g, n(3, 9))}", f"${n(1, 999)},{n(0, 999):03d}.{n(0, 99):02d}",
        f"{n(1, 999)}.{n(0, 999):03d}.{n(0, 999):03d},{n(0, 99):02d} EUR", f"978-{n(0, 9)}-{_digits(g, 2)}-{_digits(g, 6)}-{n(0, 9)}", f"{y}-{y + n(1, 60)}", f"pp. {n(1, 400)}-{n(400, 999)}", f"{n(0, 9)}.{_digits(g, 7)}", f"{n(1, 100)} %",
        f"id {_digits(g, n(5, 13))}", f"{n(1, 60)} x {n(1, 60)} cm", f"chapter {n(1, 30)}.{n(1, 30)}.{n(1, 9)}", f"@{_name(g)}", f"at {n(1, 13)} o'clock", f"look at {_name(g)} and {_name(g)}", f"at {_name(g)} . {_name(g).title()}", f"{n(1, 999)} {n(0, 999):03d} {n(0, 999):03d}",
        f"{_digits(g, 4)}.{_digits(g, 4)}.{_digits(g, 4)}", f"{n(1, 200)}-{n(200, 400)}", f"{n(100, 999)} {n(10, 99)}",
    ]
    return str(g.choice(forms))
