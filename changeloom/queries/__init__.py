"""Every operator as a query over the shared test tables, with the SQL it must agree with."""
