"""Labelled pages from which the extraction weights are fitted: markup in which marks enclose the main text.

Written for this purpose, one for each way of laying out a page that the weights
have to cope with: with and without an article element, text in paragraphs, lists,
tables, bare divisions and after line breaks, texts of a line and of many
paragraphs, and around them menus, adverts, notices, lists of links, sidebars and
reader comments, with telling class names and without, short and longer than the
text itself; in several languages.
"""

MAIN, END = "<!--main-->", "<!--/main-->"

_LONG = [
    "The river had been rising since the early morning, and by noon the lower fields were under water.",
    "People moved their animals to the hills and waited for the rain to stop, which it did in the evening.",
    "Am nächsten Tag begannen die Bewohner mit den Aufräumarbeiten, und am Abend war die Straße wieder frei.",
    "Les habitants ont remercié les pompiers, qui avaient travaillé toute la nuit sans prendre de repos.",
    "El puente quedó cerrado durante dos semanas, mientras los ingenieros revisaban cada uno de sus pilares.",
    "The council met on Thursday to talk about new walls along the bank and about who should pay for them.",
]
_SHORT = ["Nobody was hurt.", "Niemand wurde verletzt.", "More rain is expected."]


def _text(n: int, tag: str = "p", at: int = 0) -> str:
    return "".join(f"<{tag}>{_LONG[(at + i) % 6]} {_LONG[(at + i + 1) % 6]}</{tag}>" for i in range(n))


def _links(n: int, tag: str = "li", words: str = "Another story that you may like") -> str:
    return "".join(f'<{tag}><a href="/{i}">{words}</a></{tag}>' for i in range(n))


_MENU = _links(7, words="Section name")
_AD = "Buy two now and save on the third, only this week and only in our shops."
_COMMENTS = "".join(f"<div class='comment'><b>Reader {i}</b><p>I have lived here for years and {_LONG[i % 6]}</p><a href='/r'>Reply</a></div>" for i in range(8))
_COOKIES = "We and our partners store cookies on your device to measure visits and to show adverts, as our policy explains."

PAGES = [
    # an article element, a menu, an advert before it, a footer
    f"<body><nav><ul>{_MENU}</ul></nav><div class='ad'>{_AD}</div>{MAIN}<article><h1>The flood</h1>{_text(3)}<p>{_SHORT[0]}</p></article>{END}<footer>All rights kept.</footer></body>",
    # the same without any telling name, and adverts as long as a paragraph on both sides
    f"<body><div><ul>{_MENU}</ul></div><div>{_AD} {_AD}</div>{MAIN}<article><h1>The flood</h1>{_text(2)}</article>{END}<div>{_AD} {_AD} {_AD}</div></body>",
    f"<body><div>{_AD} {_AD} {_AD} {_AD}</div>{MAIN}<article><h1>A short one</h1><p>{_SHORT[0]} {_SHORT[1]} {_LONG[0]}</p></article>{END}<div>{_links(5, 'div')}</div></body>",
    # a blog: divisions only
    f"<body><div class='top'><ul>{_MENU}</ul></div><div id='wrap'>{MAIN}<div class='post'><h2>The flood</h2>{_text(4)}</div>{END}<div class='sidebar'><h3>Archive</h3><ul>{_links(9)}</ul></div></div><div>Terms and privacy</div></body>",
    f"<body><div><ul>{_MENU}</ul></div><div>{MAIN}<div><h2>List of what to do</h2><ul><li>{_SHORT[0]} {_LONG[0]}</li><li>{_LONG[1]}</li><li>{_LONG[2]}</li></ul>{_text(1)}</div>{END}<div>{_links(6, 'div')}</div></div></body>",
    # a table layout
    f"<body><table><tr><td><a href='/'>Home</a></td><td><a href='/n'>News</a></td><td><a href='/s'>Sport</a></td></tr></table>{MAIN}<div>{_text(2)}<blockquote>{_text(1)}</blockquote><p>{_SHORT[0]} <a href='/x'>More on this</a> in the paper.</p></div>{END}<form><label>Name</label><input><button>Send</button></form></body>",
    f"<body><table><tr><td><ul>{_MENU}</ul></td>{MAIN}<td><h1>The flood</h1>{_LONG[0]}<br><br>{_LONG[1]}<br><br>{_LONG[2]} {_LONG[3]}</td>{END}<td>{_links(6, 'div')}</td></tr></table></body>",
    # comments that are longer than the text
    f"<body><ul>{_MENU}</ul>{MAIN}<article><h1>The flood</h1>{_text(2)}</article>{END}<section id='comments'><h2>Comments</h2>{_COMMENTS}</section></body>",
    f"<body><ul>{_MENU}</ul>{MAIN}<div class='entry'><h1>The flood</h1>{_text(2)}</div>{END}<div id='respond'>{_COMMENTS}</div></body>",
    # notices
    f"<body><div id='cookie-notice'><p>{_COOKIES}</p><p>{_COOKIES}</p><a href='#'>Accept</a></div><main>{MAIN}<h1>The flood</h1>{_text(3, at=2)}{END}</main><div class='newsletter'><h3>Our letter</h3><p>{_AD}</p></div></body>",
    # a section with many links in its text, and one with headings
    f"<body><div><a href='/'>Logo</a></div>{MAIN}<section><h1>The flood</h1><h2>What we know</h2><p><b>{_SHORT[0]}</b></p><p>{_LONG[0]} <a href='/a'>The bridge</a> was closed and <a href='/b'>the school</a> too. {_LONG[1]}</p><h2>What comes next</h2>{_text(2, at=3)}</section>{END}<div><h3>Read next</h3>{_links(6, 'div')}</div></body>",
    f"<body><div>{_links(12, 'span')}</div>{MAIN}<div><p>{_LONG[3]}</p><p>{_LONG[4]}</p></div>{END}<div>{_links(12, 'span')}</div></body>",
    # two articles in one main element
    f"<body><ul>{_MENU}</ul><main>{MAIN}<article><h2>One</h2>{_text(4)}</article><article><h2>Two</h2>{_text(4, at=3)}</article>{END}</main><aside><ul>{_links(8)}</ul></aside></body>",
    # bare text
    f"<body><p><a href='/'>Home</a> | <a href='/a'>About</a></p>{MAIN}<p>{_LONG[0]}<p>{_LONG[1]}<p>{_LONG[5]} {_LONG[2]}{END}<hr><p><a href='/i'>Imprint</a></body>",
]
