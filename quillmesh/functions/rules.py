"""Patterns, word lists and limits that results depend on. They hold in Java's, Python's and RE2's syntax."""

# Messages that are no issue.
CONFIRM = r"(?i)confirm|verify|verification|welcome|complete your sign|one-time|added successfully|now signed up|now subscribed|thanks for signing|thank you for subscribing|a few things|verification code|on the list|activate your|you're in|you’re in"
NON_ISSUE_WORDS, WORDS_PER_MINUTE = 250, 230
# Header, what its value holds in lower case (nothing: any value), platform; the first that holds.
PLATFORMS = [
    ("List-Id", "substack", "substack"),
    ("X-Mailgun-Tag", "substack", "substack"),
    ("List-Unsubscribe", "substack.com", "substack"),
    ("List-Unsubscribe", "beehiiv", "beehiiv"),
    ("X-Beehiiv-Ids", "", "beehiiv"),
    ("X-MC-User", "", "mailchimp"),
    ("List-Id", "mcsv.net", "mailchimp"),
    ("List-Unsubscribe", "list-manage.com", "mailchimp"),
    ("List-Unsubscribe", "convertkit", "convertkit"),
    ("List-Unsubscribe", "kit.com", "convertkit"),
    ("List-Unsubscribe", "ghost", "ghost"),
    ("List-Unsubscribe", "buttondown", "buttondown"),
    ("X-SG-EID", "", "sendgrid"),
    ("X-SES-Outgoing", "", "amazon-ses"),
    ("List-Unsubscribe", "sailthru", "sailthru"),
    ("List-Unsubscribe", "hubspot", "hubspot"),
]
TAG_HEADERS = ("Delivered-To", "X-Original-To", "To", "Cc")

# Addresses.
TRACKING_PREFIXES = ("utm_", "mc_", "_hs", "oly_", "vero_", "pk_", "mtm_")
TRACKING_KEYS = ("mkt_tok", "ck_subscriber_id", "fbclid", "gclid", "dclid", "msclkid", "igshid", "_bhlid", "last_resource_guid", "elqtrackid", "elqtrack", "trkcampaign")
REDIRECT_KEYS = ("url", "u", "q", "redirect", "redirect_url", "target", "dest", "destination", "link", "r")
TRACKER_HOST = (
    r"(?i)(^|\.)(link\.mail\.beehiiv\.com|mail\.beehiiv\.com|email\.mg\.[a-z0-9.-]+|click\.convertkit-mail\d*\.com|convertkit-mail\d*\.com|list-manage\.com|sendgrid\.net|ct\.sendgrid\.net|links\.[a-z0-9-]+\.com|"
    r"click\.[a-z0-9-]+\.com|track\.[a-z0-9-]+\.com|tracking\.[a-z0-9-]+\.com|r\.[a-z0-9-]+\.com|email\.[a-z0-9-]+\.com|lnks\.gd|cl\.exct\.net|hubspotlinks\.com|mailchi\.mp|mandrillapp\.com|rs6\.net|t\.co|lnkd\.in)$"
)
SOCIAL_HOST = r"(?i)(^|\.)(twitter\.com|x\.com|facebook\.com|instagram\.com|linkedin\.com|threads\.net|tiktok\.com|bsky\.app)$"
NEWSLETTER_DOMAINS = (
    "superhuman.ai", "joinsuperhuman.ai", "tldr.tech", "tldrnewsletter.com", "theneurondaily.com", "theneuron.ai", "substack.com", "beehiiv.com", "pragmaticengineer.com", "importai.net", "jack-clark.net",
    "morningbrew.com", "sailthru.com", "list-manage.com", "kit.com", "convertkit.com", "mailchimp.com",
)
UNWRAPS, HOPS = 3, 6

# Blocks of a message.
BLOCK_TAGS = frozenset("p div td th tr table tbody thead li ul ol h1 h2 h3 h4 h5 h6 section article header footer blockquote center hr br dl dt dd pre figure figcaption main aside nav".split())
DROP_TAGS = frozenset("script style head title meta link noscript svg button form".split())
HIDDEN_STYLE = r"(?i)display\s*:\s*none|mso-hide\s*:\s*all|visibility\s*:\s*hidden|max-height\s*:\s*0(px)?\s*(;|$)|font-size\s*:\s*0(px)?\s*(;|$)|opacity\s*:\s*0(\.0+)?\s*(;|$)"
BOLD_STYLE = r"(?i)font-weight\s*:\s*(bold|[6-9]00)"
ZERO_WIDTH = "[​-‏  ‪-‮⁠-⁤﻿͏­]"
BOILERPLATE = (
    r"(?i)^(view|read|open) (this )?(email |post |issue )?(in|on) (your |a )?(browser|web|online)|^(read|view) (it )?online\b|^web version\b|"
    r"^(sign up|subscribe|advertise|view online|read online)(\s*\|\s*(sign up|subscribe|advertise|view online|read online|view in browser))+\s*$|^(sign up|subscribe)( here| now)?[.!]?$|^share (this|on)|"
    r"^forwarded this (email|newsletter)|^was this (email )?forwarded to you|^(follow us|find us) on|^(download|get) (the|our) app$|^advertise( with us)?$|^\|$"
)
FOOTER = (
    r"(?i)unsubscribe|manage (your )?(email )?(preferences|subscriptions)|update your (email )?preferences|you (are|'re|’re) receiving this|you received this|all rights reserved|no longer (want|wish) to receive|our (mailing )?address is|"
    r"what did you think of (today|this)|your opinion matters|how did we do|tell us how we did|^\W*(loved it|it was ok|terrible|good, not great|it sucked)\b|^\s*(©|copyright\s*©?)\s*\d{4}"
)
FOOTER_ZONE, FOOTER_WORDS = 0.6, 60

# Items of an issue.
TITLE_WORDS, SECTION_WORDS, ESSAY_WORDS, TEASER_WORDS, ENTRY_WORDS, INTRO_WORDS, ENTRIES_SHARE, AD_WORDS, CAPTION_WORDS = 25, 8, 150, 400, 15, 12, 0.6, 20, 40
SPONSOR_LABEL = (
    r"(?i)\(sponsor(ed)?\)|^\s*sponsor(ed|s)?\s*$|^\s*sponsored\b|(word|message|note) from our (sponsor|partner)|^\s*from our (sponsor|partner)s?\b|^\s*together with\b|^\s*presented by\b|^\s*brought to you by\b|"
    r"^\s*in partnership with\b|^\s*partner(ed)? (content|post)|^\s*advertisement\s*$|\[ad\]|\(ad\)|^\s*ad\s*[:|]"
)
SPONSOR_BODY = r"(?i)^\s*(together with|presented by|brought to you by|in partnership with|sponsored by|this (issue|newsletter|edition) is (sponsored|brought to you) by)\b"
BARE_SPONSOR = r"(?i)^\W*(together with|presented by|brought to you by|in partnership with|sponsored by|from our (sponsor|partner)s?)\W*$"
DROP_ITEM = (
    r"(?i)refer (a|your) friend|share (tldr|the neuron|this newsletter|.{0,20} with (a friend|your friends))|invite (your )?(friends|colleagues)|referral (link|program|rewards)|^\s*want to advertise|^\s*advertise with|"
    r"^\s*(love|enjoy(ing)?) (this|tldr|the newsletter)|^\s*how did we do|rate (this|today's) (issue|newsletter)|^\s*(was|did) (this|you enjoy)|^\s*feedback\b|^\s*(we're|we are) hiring|^\s*jobs? board|"
    r"^\s*send us (a )?(tip|feedback)|^\s*advertise to\b|want to work at|track your referrals|^\s*https?://\S+\s*$|^\s*(like|comment|restack|share)\s*$|^\s*share the \w+|^\s*want more\?|we just launched|"
    r"^\s*a cat[’']s commentary|^\s*watch and/or listen|\bat tldr \(\$"
)
TEASER_LINK = r"(?i)(read|keep|continue) (more|reading|the full|the rest)|read (in|on) (the )?app|(full|rest of the) (story|post|article)|upgrade to (read|paid)|subscribe to (read|keep reading)"
CALL = (
    r"(?i)^\s*(start (a |your )?(free )?trial|subscribe( now| here)?|upgrade( now)?|sign up( now)?|get (the )?app|learn more|try (it )?(for )?free|get started|book a demo|get a demo|click (here|to share)|read more|"
    r"keep reading.*|continue reading.*|read the full.*)\s*[.!→>»]*\s*$"
)
CALL_HINT = r"(?i)\b(here|today|now|register|request|read|try|get|start|join|download|claim|apply|invest|book|watch|listen|sign|seat|demo|report|blueprint|see|discover|explore|learn|check)\b"
PROMO_SUBJECT = (
    r"(?i)\d+\s?% off|\bsale\b|\bdiscount\b|\bdeal(s)? (ends|end)|last chance|limited[- ]time|upgrade to (pro|premium|paid|plus)|go (pro|premium|paid)|black friday|cyber monday|free trial|special offer|"
    r"\bwebinar\b|register (now|today)|\bpromo code\b|exclusive offer"
)
DATE_LINE = r"(?i)^(jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*\.? \d{1,2}\b"
NUMBERED_ENTRY = r"(?s)^\s*\d{1,2}[.)]\s+(?P<title>[^:]{3,140}?):\s+(?P<body>\S.*)$"
LABEL_ENTRY = r"(?s)^(?P<pre>[^\w\s]{1,4})\s*(?P<title>[A-Z0-9][^:.!?]{2,60}?):\s+(?P<body>\S.*)$"
NOT_A_LABEL = frozenset(["photo", "photos", "source", "sources", "prompt", "note", "update", "image", "video", "credit", "via", "bonus", "ps", "p.s", "tl;dr", "tldr", "why it matters", "the catch"])
NOT_A_STORY = r"(?i)^\W*(timestamps|references|show notes|transcript|chapters)\W*$|^\s*\d{1,2}:\d{2}(:\d{2})?\s*$"
PAYWALL = r"(?i)to unlock the rest|this post is for paid subscribers|keep reading with a \d+-day free trial"
READ_IN_APP = r"(?i)\bread in app\b"
READ_TIME = r"(?i)\(\s*\d+\s*(minute|min)\s*read\s*\)|\(\s*(github repo|website|sponsor)\s*\)"
TITLE_NOISE = r"(?i)\(\s*\d+\s*minute read\s*\)|\((github repo|website|sponsor)\)"

# Stories.
STOP = (
    "a an the and or but if of to in on at by for with from as is are was were be been being it its this that these those their there here he she they we you i our your his her them us not no yes do does did done have has had "
    "will would can could should may might must about into over after before than then so such just also more most very new now today week this year years day days via up out what which who whom whose why how when where all any "
    "each every some many much few other another one two three first last next own same says said say according per read minute minutes sponsor github repo website newsletter here got get make made like"
).split()
TOKEN = r"[a-z0-9][a-z0-9.+#-]*[a-z0-9+#]|[a-z0-9]"
THRESHOLD, NAME_WEIGHT, BODY_WORDS, BACKGROUND, RECURRING, IMPORTANCE, LEAST_TOKENS = 0.18, 0.25, 120, 3000, 3, 3, 3
DUPLICATE_HOURS, DUPLICATE_SHARE = 3, 0.10

# Extraction and issues.
CATEGORIES = ("launch", "funding", "research", "policy", "business", "security", "product", "people", "opinion", "tutorial", "other")
ENTITY_TYPES = ("company", "person", "product", "model", "place", "org", "other")
CLAIM_TYPES = ("fact", "number", "prediction", "opinion")
INPUT_WORDS, ITEM_WORDS, COPY = 1800, 12, 11
NUMBER = r"\d+(?:[.,]\d+)*"
CITATION = r"\[i(\d+)\]"
SOURCE_COUNT = r"(?i)\b(\d+|two|three|four|five|six)\s+(reports?|sources?|of them|outlets?)\b"
ALLOWED_NAMES = (
    "i ai ceo cto cfo us u.s uk eu api apis app apps llm llms gpu gpus cpu cpus vr ar ipo faq pdf q1 q2 q3 q4 why what the a an and but it its this that these those they we our only both meanwhile also plus still today yesterday "
    "tomorrow monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december one two three four five if so in on at for with by from as to of not no "
    "yes new top story stories newsletter newsletters source sources according everyone nobody here there when while after before until more most less some many all each every another other safe skip quick hits talking about "
    "matters readers builders you your he she his her their them is are was were will can could should would has have had be been do does did how who which where even just now then than first last next big major small early "
    "late free open"
).split()
QUIET_DAYS, LOOKBACK_DAYS, QUIET_FACTOR, QUIET_LEAST = 4, 45, 2.5, 3
CADENCE = {"daily": 3, "weekly": 9, "biweekly": 16, "3x-weekly": 5, "monthly": 32}
CADENCE_ELSE = 9
