"""The library's queries over the test tables, with equivalent SQL for comparison."""
