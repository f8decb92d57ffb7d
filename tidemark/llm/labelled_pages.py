"""Hand-labelled pages that the content model learns from.

``data-y="1"`` marks content, ``data-y="0"`` what is not; the nearest mark above
a text counts. The attribute is never a feature.
"""

LONG = ("The harbour was quiet when the first boats came back, and nobody on the quay spoke for a while. "
        "Later that day the council met to decide what should be done about the broken wall, which had "
        "been repaired twice before and would have to be repaired again. ")
MID = "A second group arrived in the evening and stayed until the lamps were lit."
SHORT = "It rained."
MENU = "<ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/c'>Contact us</a></li></ul>"


def paragraphs(n: int) -> str:
    return "".join(f"<p>{text}</p>" for text in (LONG, MID, LONG + MID, SHORT, MID + " " + MID)[:n])


#: Pages in layouts that sites commonly use.
PAGES = [
    f"""<html><head><title>A</title></head><body><header data-y=0><h1>The Daily Site</h1><p>News since 1901</p></header>
    <nav data-y=0>{MENU}</nav><main data-y=1><h1>The wall</h1>{paragraphs(5)}<h2>What next</h2>{paragraphs(3)}
    <aside class="related" data-y=0><h3>Related stories</h3>{MENU}</aside></main>
    <footer data-y=0><p>&copy; 2020 The Daily Site. All rights reserved.</p></footer></body></html>""",
    f"""<body><div id="header" data-y=0><div class="logo">Site</div><div class="menu nav">{MENU}</div></div>
    <div id="content" class="main-content" data-y=1><div class="post entry-content"><h1>On boats</h1>{paragraphs(4)}
    <ul><li>One boat was blue.</li><li>Another boat was red and old.</li></ul><blockquote>{MID}</blockquote></div>
    <div class="comments" id="comments" data-y=0><h3>3 Comments</h3><div class="comment"><p>I saw this too, great story.</p>
    <p>{MID}</p></div><form><label>Name</label><p>Leave a reply</p></form></div></div>
    <div id="sidebar" class="widget-area" data-y=0><h3>Recent posts</h3>{MENU}<div class="widget"><p>About the author of this site.</p></div></div>
    <div id="footer" data-y=0><p>Powered by software. Terms and privacy.</p></div></body>""",
    f"""<body><div class="cookie-notice banner" role="dialog" data-y=0><p>We use cookies to improve your visit. Accept all
    cookies or change your settings.</p></div><nav class="navbar" data-y=0>{MENU}</nav>
    <article class="story" data-y=1><header><h1>Lamps</h1></header><section>{paragraphs(3)}</section>
    <div class="ad advert advertisement sponsored" data-y=0><p>Buy new lamps today. Sponsored. The best lamps in town at half price.</p></div>
    <section>{paragraphs(4)}<figure><figcaption>The lamps at night.</figcaption></figure></section>
    <div class="share social" data-y=0><a href="#">Share</a> <a href="#">Post</a></div></article>
    <section class="comments-section reader-comments" data-y=0><h2>Reader comments</h2><ol><li class="comment-body"><p>{LONG}</p></li>
    <li class="comment"><p>Agreed.</p></li></ol></section><footer class="site-footer" data-y=0>{MENU}<small>Copyright</small></footer></body>""",
    f"""<body><div class="topbar" data-y=0>Call us 555 0100</div><div class="menu" role="navigation" data-y=0>{MENU}</div>
    <div class="wrapper container"><div class="article-body text" data-y=1><h1>Walls</h1>{paragraphs(5)}</div>
    <div class="sidebar" data-y=0><div class="promo"><p>Subscribe to our newsletter and never miss a story again.</p></div>
    <div class="popular">{MENU}</div></div></div><form class="newsletter subscribe signup" data-y=0><p>Sign up for our newsletter.</p>
    <label>Email</label><button>Send</button></form><div class="footer legal" data-y=0><p>All rights reserved. {SHORT}</p></div></body>""",
    f"""<body><nav data-y=0>{MENU}</nav><div class="breadcrumb breadcrumbs" data-y=0><a href="/">Home</a> &gt; <a href="/x">Harbour</a></div>
    <article data-y=1><h1>{MID}</h1><p>{SHORT}</p><p>{SHORT}</p><p>Yes.</p><p>{MID}</p><p>No</p></article>
    <aside data-y=0><p>{MID}</p><p>Notice: this page is updated daily.</p></aside>
    <div class="notice alert warning" role="alert" data-y=0><p>The site will be down on Monday for repairs.</p></div>
    <footer data-y=0><p>{MID}</p></footer></body>""",
    f"""<body><nav data-y=0>{MENU}{MENU}</nav><div class="ad" data-y=0>{LONG}</div><article data-y=1><h1>{SHORT}</h1><p>{SHORT}</p></article>
    <footer data-y=0>&copy; example &middot; {MID}</footer></body>""",
    f"""<body><nav data-y=0>{MENU}</nav><div class="ads" data-y=0>{MID}</div><article data-y=1><h1>Table of tides</h1>{paragraphs(2)}
    <table><tr><th>Day</th><th>Tide</th></tr><tr><td>Monday</td><td>High at noon</td></tr></table><pre>x = 1</pre>
    <p>See <a href="/a">the older article</a> and <a href="/b">the map of the harbour</a> for more.</p></article>
    <section id="comments" data-y=0>{paragraphs(3)}</section><footer data-y=0>{MID}</footer></body>""",
    f"""<body><header class="masthead" data-y=0><p>{MID}</p>{MENU}</header><div role="main" data-y=1><h2>Old news</h2>{paragraphs(5)}</div>
    <div role="complementary" class="side" data-y=0>{paragraphs(2)}</div><div role="contentinfo" data-y=0><p>{MID}</p></div></body>""",
    f"""<body><form class="search login" data-y=0><p>Search this site</p><label>Words</label></form><div class="page"><div class="content post-body" data-y=1>
    {LONG}<br><br>{MID}<p>{LONG}</p><div>{MID}</div><div>{LONG}</div></div><div class="respond reply" data-y=0><p>Write a comment</p>
    <p>{LONG}</p></div></div><div class="banner ad-slot" data-y=0><p>{LONG}</p></div><div class="footer" data-y=0>{MENU}</div></body>""",
]
