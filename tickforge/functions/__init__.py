"""Column expressions and the declarative quality-rule set."""
