"""English stop words removed before n-grams are formed.

Fixed values.  ``COMMON`` is Spark ML's default English list
(``StopWordsRemover.loadDefaultStopWords("english")``) in its own order.  The
list that the linking job's vectorizer uses is that list without contractions
and the ten words of ``NOT_STOPPED``, plus ``MORE``.
Kept as text so the SQL oracle can use the same list without a JVM.
"""

COMMON = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're
he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't
didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's
when's where's who's why's would""".split()

NOT_STOPPED = "did does doing don having just ought s t theirs".split()

MORE = """across afterwards almost alone along already also although always among amongst amoungst amount another anyhow anyone
anything anyway anywhere around back became become becomes becoming beforehand behind beside besides beyond bill
bottom call cant co con couldnt cry de describe detail done due eg eight either eleven else elsewhere empty enough etc
even ever every everyone everything everywhere except fifteen fifty fill find fire first five former formerly forty
found four front full get give go hasnt hence hereafter hereby herein hereupon however hundred ie inc indeed interest
keep last latter latterly least less ltd made many may meanwhile might mill mine moreover mostly move much must name
namely neither never nevertheless next nine nobody none noone nothing nowhere often one onto others otherwise part per
perhaps please put rather re see seem seemed seeming seems serious several show side since sincere six sixty somehow
someone something sometime sometimes somewhere still system take ten thence thereafter thereby therefore therein
thereupon thick thin third though three throughout thru thus together top toward towards twelve twenty two un upon us
via well whatever whence whenever whereafter whereas whereby wherein whereupon wherever whether whither whoever whole
whose within without yet""".split()

ENGLISH = [w for w in COMMON if "'" not in w and w not in NOT_STOPPED] + MORE
