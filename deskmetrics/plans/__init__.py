"""Plans: the ticket model, reports, dashboard data sets, pipeline, query catalog."""
