"""Lookup tables used by the text functions, and the rule for symbols."""

from __future__ import annotations

# Contractions and their expansions. Each is matched as a whole
# word with one space on either side, after lower-casing.
CONTRACTION_TEXT = """
ain't = is not
aint = is not
isnt = is not
aren't = are not
arent = are not
can't = cannot
cant = cannot
'cause = because
could've = could have
couldve = could have
couldn't = could not
couldnt = could not
didn't = did not
didnt = did not
doesn't = does not
doesnt = does not
don't = do not
dont = do not
hadn't = had not
hadnt = had not
hasn't = has not
hasnt = has not
haven't = have not
havent = have not
he'd = he would
he'll = he will
he's = he is
how'd = how did
how'd'y = how do you
how'll = how will
how's = how is
i'd = i would
i'd've = i would have
i'll = i will
i'll've = i will have
i'm = i am
im = i am
i've = i have
isn't = is not
it'd = it would
it'd've = it would have
it'll = it will
it'll've = it will have
it's = it is
let's = let us
ma'am = madam
mayn't = may not
might've = might have
mightn't = might not
mightn't've = might not have
must've = must have
mustn't = must not
mustn't've = must not have
needn't = need not
needn't've = need not have
o'clock = of the clock
oughtn't = ought not
oughtn't've = ought not have
shan't = shall not
sha'n't = shall not
shan't've = shall not have
she'd = she would
she'd've = she would have
she'll = she will
she'll've = she will have
she's = she is
should've = should have
shouldn't = should not
shouldn't've = should not have
so've = so have
so's = so as
this's = this is
that'd = that would
that'd've = that would have
that's = that is
there'd = there would
there'd've = there would have
there's = there is
here's = here is
they'd = they would
they'd've = they would have
they'll = they will
they'll've = they will have
they're = they are
they've = they have
to've = to have
wasn't = was not
we'd = we would
we'd've = we would have
we'll = we will
we'll've = we will have
we're = we are
we've = we have
weren't = were not
what'll = what will
what'll've = what will have
what're = what are
what's = what is
what've = what have
when's = when is
when've = when have
where'd = where did
where's = where is
where've = where have
who'll = who will
who'll've = who will have
who's = who is
who've = who have
why's = why is
why've = why have
will've = will have
won't = will not
won't've = will not have
would've = would have
wouldn't = would not
wouldn't've = would not have
y'all = you all
y'all'd = you all would
y'all'd've = you all would have
y'all're = you all are
y'all've = you all have
you'd = you would
you'd've = you would have
you'll = you will
you'll've = you will have
you're = you are
you've = you have
"""

# Masked profanity and the word it stands for, in the order in
# which the replacements are made. A `*` stands for itself.
MASKED_WORD_TEXT = """
sh*t = shit
f*ck = fuck
fu*k = fuck
f**k = fuck
f**king = fucking
p*ssy = pussy
pu**y = pussy
p*ss = piss
b*tch = bitch
bit*h = bitch
h*ll = hell
cr*p = crap
d*mn = damn
stu*pid = stupid
st*pid = stupid
n*gger = nigger
f*ggot = faggot
scr*w = screw
pr*ck = prick
g*d = god
a*s = ass
a**hole = asshole
"""

# Default sentiment lexicon: word and weight, positive above zero. A short
# general-purpose list; callers pass their own for real use.
SENTIMENT_TEXT = """
good = 1.0
great = 1.5
love = 1.5
happy = 1.5
hope = 1.0
thanks = 1.0
nice = 1.0
joy = 1.5
smile = 1.0
beautiful = 1.5
bad = -1.0
hate = -1.5
sad = -1.5
alone = -1.0
hurt = -1.5
die = -2.0
death = -1.5
kill = -2.0
pain = -1.5
cry = -1.0
worthless = -2.0
hopeless = -2.0
"""


def pairs(text: str) -> list[tuple[str, str]]:
    """Read ``left = right`` lines."""
    rows = (line.split(" = ", 1) for line in text.strip().splitlines())
    return [(left, right) for left, right in rows]


CONTRACTIONS = pairs(CONTRACTION_TEXT)
MASKED_WORDS = pairs(MASKED_WORD_TEXT)
SENTIMENT = {word: float(weight) for word, weight in pairs(SENTIMENT_TEXT)}


# --- symbols ---------------------------------------------------------------
# The default rule goes by the general category of a code point, in notation
# that the regular expressions of Java and RE2 share. Letters, marks and digits
# of all scripts are kept. Deleted are controls, formats, private use and odd
# blanks, and the planes of styled letters and emoji; isolated are punctuation,
# signs and numbers that are no digits. Exact lists can be passed in place.

DELETE_CLASS = (
    r"\p{Cc}\p{Cf}\p{Co}\p{Zl}\p{Zp}"
    r"\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"  # blanks but the plain one
    r"\x{fe00}-\x{fe0f}"  # variation selectors
    r"\x{1d400}-\x{1d7ff}\x{1f000}-\x{1faff}"  # styled letters, emoji
)
ISOLATE_CLASS = r"\p{P}\p{S}\p{No}"  # without apostrophes, straight or curly
