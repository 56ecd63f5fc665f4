"""Full licence texts in the forms that they are met in.

Whole files lie in license_texts, named by their SPDX id. A canonical form ignores case, punctuation, spacing and wrapping, but not titles,
appendices or numbers of clauses; each of these gives a form of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product
from pathlib import Path

FOLDER = Path(__file__).parent / "license_texts"
END = "END OF TERMS AND CONDITIONS"
#: What follows the terms, by its first words.
APPENDIX = re.compile(r"^[ \t]*(APPENDIX: How to apply|How to Apply These Terms|Appendix: How to Apply These Terms|ADDENDUM: How to use)", re.MULTILINE | re.IGNORECASE)
ADDRESS = re.compile(r"51 Franklin Street, Fifth Floor, Boston, MA\s+02110-1301,?\s+USA")
ADDRESSES = ("59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "675 Mass Ave, Cambridge, MA 02139, USA", "<https://fsf.org/>", "<http://fsf.org/>")
#: Title lines of short licences; none of them is met as often as any.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License", "0BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC License (ISCL)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License", "BSD License", "The BSD License"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"),
}


def _paragraphs(text: str) -> list[str]:
    return [x for x in re.split(r"\n[ \t\f]*(?:\n[ \t\f]*)+", text.strip()) if x.strip()]


def _unwrapped(text: str) -> str:
    """Each paragraph in one line; with its first line, one that states a copyright is then gone as a whole."""
    return "\n\n".join(" ".join(x.split()) for x in _paragraphs(text))


def _long(text: str) -> Iterator[str]:
    """With and without the appendix and the line before it, the title, and the publisher's addresses."""
    ends = {text}
    if at := APPENDIX.search(text):
        ends.add(text[: at.start()])
    ends |= {re.sub(rf"\s*{END}\s*$", "\n", x) for x in ends}
    for x in sorted(ends):
        parts = _paragraphs(x)
        titles = 3 if parts[0].startswith("Creative Commons Legal Code") else 2
        for k in range(titles if re.search("license|legal code", parts[0], re.IGNORECASE) and len(parts[0]) < 200 else 1):
            bare = "\n\n".join(parts[k:])
            for y in {bare, *(ADDRESS.sub(a, bare) for a in ADDRESSES)}:
                for z in {y, y.replace("https://", "http://"), y.replace("http://", "https://")}:
                    yield from (z, _unwrapped(z))


def _short(name: str, text: str) -> Iterator[str]:
    """With each title and none, with and without numbers of clauses."""
    body = text.removeprefix("MIT License\n")
    bodies = {body, re.sub(r"(?m)^\d\. ", "", body)}
    bodies |= {x.replace("modify, and/or distribute", "modify, and distribute") for x in bodies}
    for title, x in product(("", *TITLES[name]), sorted(bodies)):
        yield f"{title}\n\n{x}"


def forms(short: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(licence, text) for every form of the files and of the ``short`` texts that have titles."""
    every = [(p.stem, x) for p in sorted(FOLDER.glob("*.txt")) for x in _long(p.read_text(encoding="utf-8"))]
    return sorted({*every, *((name, x) for name, text in short if name in TITLES for x in _short(name, text))})
