"""Customer-retention analytics on Spark: cancellation and reactivation reports,
reversible churn, sales goals, postal codes from mail, and lead scoring."""
