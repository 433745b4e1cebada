"""Main text of pages whose layout says nothing of what it holds."""

import pytest

from lodestone.llm import extraction
from lodestone.llm.dom import parse, text_of

TITLE = "<h1>Of ships and harbours</h1>"
TEXTS = [f"Ver lin karo meno the {k} dispel the gramis and noble terlin, paso lor." for k in range(5)]
PARTS = "".join(f"<p>{t}</p>" for t in TEXTS)
LINKED = "".join(f'<p><a href="/{k}">{t}</a></p>' for k, t in enumerate(TEXTS))
ALL = " ".join(TEXTS)
NAV, FOOT = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>', "<footer>&copy; Vero</footer>"
LAYOUTS = {
    "bare body": (f"<body>{TITLE}{PARTS}</body>", f"Of ships and harbours {ALL}"),
    "many paragraphs": (f"<body>{PARTS * 4}</body>", " ".join([ALL] * 4)),
    "center and font": (f"<body><center><font size=2>{PARTS}</font></center></body>", ALL),
    "unnamed div": (f"<body><div>{PARTS}</div></body>", ALL),
    "div in div": (f"<body><div><div>{TITLE}{PARTS}</div></div></body>", f"Of ships and harbours {ALL}"),
    "table cell": (f"<body><table><tr><td>{PARTS}</td></tr></table></body>", ALL),
    "section": (f"<body><section>{PARTS}</section></body>", ALL),
    "one linked paragraph": (f'<body><article><p><a href="/x">{TEXTS[0]}</a></p></article></body>', TEXTS[0]),
    "linked paragraphs": (f"<body>{NAV}<article>{LINKED}</article>{FOOT}</body>", ALL),
    "line breaks": (f"<body>{'<br><br>'.join(TEXTS)}</body>", ALL),
    "no tags around": (PARTS, ALL),
    "bare body with menu": (f"<body>{NAV}{PARTS}{FOOT}</body>", ALL),
    "unnamed div with menu": (f"<body>{NAV}<div>{TITLE}{PARTS}</div>{FOOT}</body>", f"Of ships and harbours {ALL}"),
    "wrapper": (f'<body><div id="wrapper">{NAV}<div>{PARTS}</div>{FOOT}</div></body>', ALL),
    "article": (f"<body>{NAV}<article>{PARTS}</article>{FOOT}</body>", ALL),
    "sidebar beside": (f'<body>{NAV}<div>{PARTS}</div><div class="sidebar"><h3>More</h3><p>{TEXTS[1]}</p></div>{FOOT}</body>', ALL),
    "comments below": (f'<body><div>{PARTS}</div><div class="comments"><div class="comment"><p>{TEXTS[2]}</p></div></div></body>', ALL),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layout(name):
    page, want = LAYOUTS[name]
    assert extraction.main_text(f"<!DOCTYPE html><html><head><title>t</title></head>{page}</html>", extraction.train()) == want


def test_composed_pages():
    model, good = extraction.train(), 0
    for page in extraction.labelled_pages(300, 4321):
        nodes, pieces = parse(page, labelled=True)
        good += extraction.main_text(page, model) == text_of(pieces, [x.label == "1" and not x.silent for x in nodes])
    assert good >= 285
