"""Vocabulary of the URL filter, by subject.

Written by hand for this package, in the subjects that public block lists have (adult, gambling,
pirated and harmful software, drugs by mail, advertising and tracking, spam). No published list
was copied; none was at hand. A strict term rejects by itself, so it is a word that hardly occurs
in the address of a harmless page; two different soft ones do.
"""

STRICT = (
    # adult
    "porn", "porno", "pornography", "xxx", "hentai", "escort", "escorts", "milf", "camgirl", "camgirls", "sexcam",
    "sexcams", "xvideos", "xnxx", "xhamster", "redtube", "youporn", "pornhub", "bukkake", "gangbang", "blowjob",
    # pirated and harmful software
    "warez", "keygen", "keygens", "crackz", "serialz", "nulled", "malware", "phishing", "ransomware", "keylogger",
    "botnet", "spyware", "adware",
    # gambling
    "sportsbook", "sportsbetting", "onlinecasino", "freespins", "pokies",
    # drugs by mail
    "viagra", "cialis", "levitra", "kamagra", "tramadol", "phentermine",
    # advertising, tracking, spam
    "adserver", "adservice", "adclick", "popunder", "doubleclick", "clickbait", "linkfarm", "spam", "spammer", "scam",
)

SOFT = (
    # adult
    "adult", "adults", "nude", "nudes", "naked", "sex", "sexy", "erotic", "erotica", "fetish", "webcam", "webcams",
    "hookup", "singles", "dating", "lingerie", "hot", "babes", "girls",
    # pirated software
    "torrent", "torrents", "crack", "cracked", "serial", "pirate", "hack", "hacks", "cheats", "unlocked",
    # gambling
    "casino", "casinos", "poker", "bet", "bets", "betting", "gambling", "gamble", "jackpot", "roulette", "blackjack",
    "slots", "bingo", "lottery", "lotto", "bookmaker", "odds", "wager", "win", "winner", "spins",
    # drugs by mail
    "pill", "pills", "pharmacy", "meds", "prescription", "steroids", "weightloss",
    # advertising, tracking
    "ad", "ads", "advert", "adverts", "banner", "banners", "popup", "popups", "sponsored", "affiliate", "affiliates",
    "track", "tracker", "trackers", "tracking", "pixel", "beacon", "click", "clicks", "redirect",
    # money and lures
    "free", "cheap", "bonus", "prize", "prizes", "deal", "deals", "discount", "coupon", "coupons", "giveaway",
    "loan", "loans", "payday", "credit", "forex", "crypto", "replica", "rolex", "earn", "cash",
)
