"""Where data comes from: topics, typed topic tables, change captures, configuration and lookup tables."""
