"""Column expressions: text helpers, dictionaries, money and tiers."""
