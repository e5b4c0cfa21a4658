"""Domain plans: cleaning, modelling, reports, explorer, ETL job."""
