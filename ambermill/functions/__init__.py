"""ambermill.functions"""
