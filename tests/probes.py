"""Short texts of our own, one or more per kind."""

PROBES = [
    ("chinese_everyday", "周六我们一起去爬山"),
    ("chinese_business", "客户合同与付款账号，请勿外传"),
    ("chinese_public", "行业年度公开数据汇总"),
    ("chinese_digits", "总价4096元，仅供内部"),
    ("digits", "90817263544321"),
    ("repeated", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz"),
    ("random_latin", "xkqvjwzpthgbmrfnd" * 4),
    ("english", "The meeting starts at nine o'clock."),
    ("empty", ""),
    ("null", None),
    ("blank", " \t\n  "),
    ("emoji", "well done 👍🏽 everyone"),
    ("special", "end of part one [SEP] and part two [MASK]"),
    ("long", "word " * 200),
    ("control", "a\x00b\x07c​d e\x0bf"),
    ("accents", "Straße für Größenänderungen à côté"),
    ("unicode_space", "one　two three four"),
]
