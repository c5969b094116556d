"""Where tables, raw pages, configurations and reports come from and go to."""
