"""The labelled table for main-text extraction: small pages and one label for each
of their text blocks, in order (+ main text, - anything else)."""

LONG = "Down by the harbour the boats were pulled up for the winter, and the men who owned them had gone inland to look for work. "
MORE = "It had been a poor year for fishing; what the storms had left, the new regulations took, and few expected the spring to be better. "
LINK = '<a href="/x">{}</a>'

PAGES: list[tuple[str, str]] = [
    # semantic elements
    (f"""<html><head><title>t</title></head><body><header><a href="/">The Daily Tide</a><p>News from the coast since 1920</p></header>
<nav><ul><li>{LINK.format('Home')}</li><li>{LINK.format('Sport')}</li><li>{LINK.format('Weather today')}</li></ul></nav>
<article><h1>Harbour empties</h1><p>{LONG}</p><p>Nobody complained.</p><p>{MORE}See {LINK.format('our earlier report')}.</p><h2>Spring</h2><p>Short.</p></article>
<aside><h3>Most read</h3><p>{LONG}</p></aside><footer><p>Copyright 2020 The Daily Tide, all rights reserved.</p></footer></body></html>""",
     "-----++++++---"),
    # paragraphs of every length, unclosed tags, an advert
    (f"""<body><nav><a>The</a><li><a>and</a></li></nav><div class="ad">Buy two boats, pay one.</div><article><h1>A title</h1><p><b>A title<br><p>Yes.<p>{LONG}
<p>Two words<p>{MORE}</article><footer>&copy; somebody &middot; all rights</footer>""",
     "---++++++-"),
    # wrappers with speaking class names, no semantic elements
    (f"""<body class="has-sidebar"><div id="header"><p>The Gazette</p></div><div class="menu">{LINK.format('Front page')} {LINK.format('World')} {LINK.format('Opinion')}</div>
<div id="wrap"><div class="story"><h1>Boats ashore this winter</h1><p>{LONG}{MORE}</p><p>{MORE}</p><p>So it was said.</p><ul><li>Nets are mended in the loft of the old school.</li><li>Hulls are painted.</li></ul><p>{LONG}</p></div>
<div id="comments"><h3>2 comments</h3><p>{LONG}</p><p>Agreed!</p></div></div>
<div class="sidebar"><h4>Related</h4><p>{MORE}</p></div><div class="footer-links"><p>{LINK.format('Imprint')} {LINK.format('Contact')}</p></div></body>""",
     "--+++++++-----" + "-"),
    # nothing speaks but densities
    (f"""<body><div>{LINK.format('Home')} | {LINK.format('About us')} | {LINK.format('Contact')}</div>
<table><tr><td>{LINK.format('Back to the list')}</td></tr></table>
<div><p>{LONG}</p><p>{MORE}{LONG}</p><p>{MORE}</p></div><div>{LINK.format('Next page')}</div><div>{LINK.format('Read all about it in our shop')}</div></body>""",
     "--+++--"),
    (f"""<body><div>{LINK.format('One')}</div><div>{LINK.format('Two')}</div><div>{LINK.format('Three')}</div><h1>On nets</h1><div>{LONG}</div><div>They shrugged and went home.</div><div>{MORE}</div>
<div>{LINK.format('Four')}</div><div>{LINK.format('Five')} {LINK.format('Six')}</div><div>Page 1</div></body>""",
     "---++++---"),
    # main element with notices and forms inside
    (f"""<body><div class="cookie-notice"><p>We use cookies to give you the best experience on our site and to count visitors. {LONG}</p></div><main><h1>Ropes</h1><p>{MORE}</p>
<form><label>Your mail</label><p>Subscribe to our letter and get the news each morning.</p></form><div class="advertisement"><p>{LONG}</p></div><blockquote>{LONG}</blockquote><p>The end.</p>
<section class="comments"><article class="comment"><p>{MORE}</p></article><article class="comment"><p>First!</p></article></section></main><div>{LINK.format('Top')}</div></body>""",
     "-++---++---"),
    # lists of links inside the article's element, long link texts
    (f"""<body><article><header><h1>Tar and oakum</h1></header><p>{LONG}</p><p>{LINK.format(LONG)}</p><p>A note on {LINK.format('oakum')}.</p><ul class="share"><li>{LINK.format('Mail')}</li><li>{LINK.format('Print')}</li></ul>
<div class="related"><p>{LINK.format('More on tar')}</p></div><p>{MORE}</p></article><div role="complementary"><p>{LONG}</p></div></body>""",
     "++++---+-"),
    (f"""<body><div>Login</div><div>Search</div><div>Help</div><p>{LONG}{MORE}</p><h2>What came after</h2><p>{MORE}</p><p>{LONG}</p><div>Imprint</div><div>Terms</div></body>""",
     "---++++--"),
    # sections of an article whose names may also be those of something else
    (f"""<body><article><h1>Tolls</h1><p>{LONG}</p><section id="discussion"><h2>Discussion</h2><p>{MORE}</p><p>{LONG}</p></section>
<div class="related"><p>{LINK.format('More on tar')}</p></div><div class="legal-history"><h3>The law of 1851</h3><p>{LONG}{MORE}</p><p>Repealed.</p></div>
<div class="social">Follow us</div><div class="follow">{LINK.format('Mail')} {LINK.format('Letters')}</div><p>{MORE}</p></article></body>""",
     "+++++-+++--+"),
    (f"""<body><main><h1>Rates</h1><p>{MORE}</p><div class="popular"><p>{LINK.format('Ten nets')}</p><p>{LINK.format('Five ropes')}</p></div>
<div id="related-work"><p>{LONG}</p></div><div class="tags">{LINK.format('fish')} {LINK.format('law')}</div><p>{LONG}</p></main></body>""",
     "++--+-+"),
    (f"""<body><article><h1>Dues</h1><p>{LONG}</p><div class="related"><p>{LINK.format(LONG)}</p></div><p>{MORE}</p><div class="social">Follow us everywhere you go</div>
<p>{LONG}</p><div class="popular"><p>{LINK.format(MORE)}</p></div><p>So.</p><p>{LINK.format(MORE)}</p></article></body>""",
     "++-+-+-++"),
    # one-line articles
    ("<body><nav><a>A</a></nav><article><p>Gone.</p></article><footer>f</footer></body>", "-+-"),
    ("<body><div class='ad'>x y z</div><article><h1>One</h1></article></body>", "-+"),
    # text beside the article is not of it, however long; links within it are
    (f"<body><div>{LONG}</div><article><p>{MORE}</p><p>{LINK.format(LONG)}</p><p>{LINK.format('Here')}.</p><p>So.</p></article><div>{MORE}{LONG}</div><p>{LONG}</p></body>",
     "-++++--"),
    (f"<body><p>{MORE}</p><div>Welcome to our page</div><main><h1>Knots</h1><p>{LONG}</p><p>Fin.</p></main><div>{LONG}</div><div>Go</div></body>",
     "--+++--"),
    # without an article element short blocks count by what surrounds them
    (f"<body><div>Menu</div><div>Welcome, dear guest</div><div>{LINK.format('Start')}</div><p>{LONG}</p><p>Indeed.</p><p>{MORE}</p><p>{LINK.format('our shop')} has it all</p><div>Page 2 of 3</div></body>",
     "---+++--"),
    (f"<body><div>{LINK.format('Start')}</div><h1>Anchors</h1><p>{MORE}{LONG}</p><p>They hold.</p><p>{LONG}</p><div>All rights reserved</div><div>{LINK.format('Top')}</div></body>",
     "-++++--"),
    ("<body><main><p>See below.</p></main><div>Some other text that stands below the main element of it.</div></body>", "+-"),
]
