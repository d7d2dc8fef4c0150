"""Labelled pages that the weights of main text are fitted on.

No labelled pages from the web are at hand, so pages are put together by a rule: a layout, of several kinds (elements that speak
for themselves, named divisions, nested tables, divisions with meaningless names), is filled with pieces of an article and of
what surrounds or interrupts it. Each piece is marked as main text or rest by the attribute ``data-label`` on its outer element, which
no weight can see. The same seed gives the same pages.
"""

from __future__ import annotations

import random

SENTENCES = (
    "The river had risen through the night and by morning the lower road was under water.",
    "Nobody in the village could remember a winter that had begun so early.",
    "She opened the letter twice before she understood what it meant for her brother.",
    "According to the report, nearly half of the bridges need repairs within ten years.",
    "We measured the temperature every hour, and the results were the same each time.",
    "Heat the oil in a heavy pan, add the onions and stir them until they are golden.",
    "The function returns the number of rows, or zero if the table is empty.",
    "It was the third time that the two teams had met that season.",
    "Several members of the council voted against the plan, but it passed in the end.",
    "From the top of the tower one can see the harbour and the islands behind it.",
    "Der Zug hielt lange auf freier Strecke, und niemand wusste warum.",
    "Am Abend saßen sie vor dem Haus und sprachen über die Ernte.",
    "Le matin, les rues étaient vides et la neige couvrait les toits.",
    "Il avait oublié son chapeau dans le train, et il pleuvait depuis midi.",
    "La casa estaba al final del camino, detrás de unos árboles muy altos.",
    "Cuando llegaron a la plaza, la fiesta ya había terminado.",
    "In 1887 the line was extended to the coast; it was closed again after the war.",
    "“I would do it again,” he said, “but not for the same money.”",
    "What follows from this is less clear than it seems.",
    "The second edition corrects most of these errors and adds an index.",
)
HEADINGS = ("A winter by the river", "What the report says", "Before you begin", "Der lange Weg", "Un matin de neige", "The last train", "Method", "La plaza", "Results and outlook", "How it ended")
SHORT = ("two onions", "a pinch of salt", "Ten years later", "see the table", "4 metres", "step one", "Chapter 2", "zwei Eier", "du sel", "No change")
LINKS = ("Home", "About us", "Contact", "News", "Sports", "Shop", "Archive", "Start", "Kontakt", "Impressum", "Accueil", "Inicio", "Log in", "My account", "Politics", "Weather", "Help", "Recipes", "Next page", "Older posts")
#: What stands around an article or interrupts it: texts, and ways to mark them up ({t} the text, {l} links, {n} a meaningless name).
REST = {
    "ad": (
        ("Buy two pans and get the third one for free", "Save 20 % on all boots until Sunday", "Advertisement", "Sponsored: the phone that everybody wants", "Jetzt kaufen und sparen", "Offre spéciale: -30 % sur tout", "Compra ahora con descuento", "Our best offer of the week, only today"),
        ('<div class="ad">{t}</div>', '<div class="advert banner"><p>{t}</p></div>', '<aside class="sponsored">{t}</aside>', '<div id="ad-slot"><a href="/x">{t}</a></div>', '<div class="promo-box"><p>{t}</p></div>', '<ins class="adsense">{t}</ins>', '<section class="advertisement"><h4>{t}</h4></section>'),
    ),
    "notice": (
        ("We use cookies to make your visit better. Accept all", "This site uses cookies. By staying you agree to our privacy policy.", "Diese Seite verwendet Cookies. Einverstanden", "Nous utilisons des cookies. Tout accepter", "Usamos cookies. Aceptar", "Please turn off your blocker to go on reading"),
        ('<div class="cookie-notice">{t}</div>', '<div id="consent"><p>{t}</p></div>', '<div role="dialog" class="popup">{t}</div>', '<div class="alert warning">{t}</div>', '<div role="alert">{t}</div>', '<dialog open>{t}</dialog>'),
    ),
    "form": (
        ("Subscribe to our newsletter", "Sign up for our letter and get a recipe each week", "Your mail address Sign up", "Search this site", "Newsletter abonnieren", "Abonnez-vous à notre lettre", "Suscríbete a nuestro boletín"),
        ("<form action=\"/s\"><label>{t}</label><input name=q></form>", '<div class="newsletter"><p>{t}</p><input></div>', '<form class="search"><p>{t}</p></form>', '<div class="signup subscribe">{t}</div>', "<form><fieldset><legend>{t}</legend></fieldset></form>"),
    ),
    "share": (
        ("Share Tweet Print", "Share this article", "Teilen Drucken", "Partager", "Compartir", "Tags: rain, river"),
        ('<div class="share">{t}</div>', '<ul class="social"><li><a href="#">{t}</a></li></ul>', '<p class="tags"><a href="#">{t}</a></p>', '<div class="tools"><a>{t}</a></div>'),
    ),
    "nav": (
        ("",),
        ("<nav><ul>{l}</ul></nav>", '<div class="menu"><ul>{l}</ul></div>', '<div id="navigation">{l}</div>', '<div role="navigation"><ul>{l}</ul></div>', '<ul class="breadcrumb">{l}</ul>', '<div class="pagination">{l}</div>', "<div><ul>{l}</ul></div>", '<div class="{n}"><ul>{l}</ul></div>', "<table><tr>{l}</tr></table>"),
    ),
    "aside": (
        ("More stories", "Related articles", "Read more", "Most read today", "Mehr zum Thema", "À lire aussi", "Te puede interesar"),
        ("<aside><h3>{t}</h3><ul>{l}</ul></aside>", '<div class="sidebar"><h2>{t}</h2><ul>{l}</ul></div>', '<div class="related widget"><h4>{t}</h4>{l}</div>', '<div role="complementary"><p>{t}</p><ul>{l}</ul></div>', '<div class="recommended"><h3>{t}</h3><ul>{l}</ul></div>', '<div class="{n}"><h3>{t}</h3><ul>{l}</ul></div>'),
    ),
    "comments": (
        ("I was there and it was fun!", "first one here", "Great article, thank you", "I do not agree with this at all. The bridge was fine when I crossed it last week.", "Danke für den Bericht", "Merci beaucoup", "Leave a reply"),
        ('<section id="comments"><h3>Comments</h3><div class="comment"><p>{t}</p></div></section>', '<div class="comments"><div class="comment-body"><p>{t}</p></div><a>Reply</a></div>', '<ol class="commentlist"><li><b>Ann</b> <p>{t}</p></li></ol>', '<div class="discussion"><h4>2 replies</h4><p>{t}</p></div>'),
    ),
    "footer": (
        ("© 2020 The daily page. All rights reserved.", "Copyright the kitchen", "© therha.example.com · Powered by hand", "Alle Rechte vorbehalten", "Tous droits réservés", "Todos los derechos reservados"),
        ("<footer>{t}</footer>", "<footer><p>{t}</p><ul>{l}</ul></footer>", '<div id="footer"><p>{t}</p>{l}</div>', '<div class="copyright">{t}</div>', '<div role="contentinfo">{t}</div>', '<div class="{n}"><small>{t}</small></div>', "<table><tr><td>{t}</td></tr></table>"),
    ),
    "header": (
        ("The daily page", "City paper - since 1901", "My kitchen blog", "Project documentation"),
        ("<header><p>{t}</p></header>", '<div class="header"><a href="/">{t}</a></div>', '<div id="masthead"><span>{t}</span></div>', '<div role="banner">{t}</div>', '<div class="logo"><a href="/">{t}</a></div>', '<div class="{n}"><a href="/">{t}</a></div>'),
    ),
}
#: Ways to hold the article ({m}) in what surrounds it ({a} before, {z} after).
LAYOUTS = (
    "<body>{a}<main><article {label}>{m}</article></main>{z}</body>",
    "<body>{a}<article {label}>{m}</article>{z}</body>",
    '<body><div id="wrapper">{a}<div id="content" {label}>{m}</div>{z}</div></body>',
    '<body>{a}<div class="container"><div class="post-content" {label}>{m}</div></div>{z}</body>',
    '<body><div class="{n}">{a}<div class="{n}"><div class="{n}" {label}>{m}</div></div>{z}</div></body>',
    "<body>{a}<div><div {label}>{m}</div></div>{z}</body>",
    "<body><table><tr><td>{a}</td><td {label}>{m}</td><td>{z}</td></tr></table></body>",
    '<body>{a}<div role="main"><section class="entry story" {label}>{m}</section></div>{z}</body>',
    "<body>{a}<section {label}>{m}</section>{z}</body>",
)
BEFORE, AFTER, BETWEEN = ("header", "nav", "notice", "ad", "form"), ("comments", "aside", "share", "ad", "footer", "nav", "form"), ("ad", "form", "share", "notice")


def _rest(rng: random.Random, role: str) -> str:
    texts, ways = REST[role]
    way, links = rng.choice(ways), rng.sample(LINKS, rng.randint(2, 7))
    tag = "td" if "<tr>{l}" in way else "li" if "<ul>{l}" in way or "<ol>{l}" in way else "span"
    # what it says tells little: an advert may be made of sentences like any others
    said = rng.choice(texts) if rng.random() < 0.5 else " ".join(rng.choices(SENTENCES, k=rng.choice((1, 1, 2, 5))))
    filled = way.format(t=said, l="".join(f'<{tag}><a href="/{i}">{x}</a></{tag}>' for i, x in enumerate(links)), n=_name(rng))
    return filled.replace(">", ' data-label="rest">', 1)


def _name(rng: random.Random) -> str:
    return "".join(rng.choices("bcdfghjkmnpqrstvwxz", k=5)) + str(rng.randint(1, 9))


def _main(rng: random.Random) -> str:
    parts = [f"<h1>{rng.choice(HEADINGS)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 7)):
        said = " ".join(rng.choices(SENTENCES, k=rng.randint(1, 6))) if rng.random() < 0.7 else rng.choice(SHORT + HEADINGS)
        kind = rng.random()
        if kind < 0.6:
            parts.append(rng.choice((f"<p>{said}</p>", f"<p>{said}<br>{rng.choice(SENTENCES)}</p>", f"<p><b>{said}</b></p>", f'<p>{said} <a href="/s">{rng.choice(SHORT)}</a>.</p>', f"<div>{said}</div>")))
        elif kind < 0.7:
            level = rng.choice((2, 2, 3, 4))
            parts.append(f"<h{level}>{rng.choice(HEADINGS)}</h{level}><p>{said}</p>")
        elif kind < 0.8:
            parts.append(rng.choice(("<ul>{}</ul>", "<ol>{}</ol>")).format("".join(f"<li>{x}</li>" for x in rng.sample(SHORT + SENTENCES, 3))))
        elif kind < 0.85:
            parts.append("<table><tr>" + "</tr><tr>".join(f"<th>{a}</th><td>{b}</td>" for a, b in zip(rng.sample(SHORT, 2), rng.sample(SENTENCES, 2), strict=True)) + "</tr></table>")
        elif kind < 0.9:
            parts.append(f"<blockquote><p>{said}</p></blockquote>")
        elif kind < 0.95:
            parts.append(f"<figure><figcaption>{rng.choice(SHORT)}</figcaption></figure><p>{said}</p>")
        else:
            parts.append(f"<pre>{rng.choice(SHORT)}</pre><p>{said}</p>")
        if rng.random() < 0.2:
            parts.append(_rest(rng, rng.choice(BETWEEN)))
    return "".join(parts)


def pages(n: int = 180, seed: int = 11) -> list[str]:
    rng = random.Random(seed)
    found = []
    for i in range(n):
        before = "".join(_rest(rng, r) for r in BEFORE if rng.random() < 0.6)
        after = "".join(_rest(rng, r) for r in AFTER if rng.random() < 0.6)
        found.append(LAYOUTS[i % len(LAYOUTS)].format(a=before, z=after, m=_main(rng), n=_name(rng), label='data-label="main"'))
    return found
