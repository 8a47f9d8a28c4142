"""Column-level rules: scorecard measures and BI measures. All are built-in expressions and stay
inside whole-stage code generation."""
