"""DataFrame -> DataFrame operators (context, scoring, reports, explanations, payroll)."""
