import os
import tempfile

from callweave.sources import extract as EX

SNIPPET = '''package com.company;
/* class Fake { void no() {} } */
public class Main extends Base {
    private int a, b;
    /**
     * Javadoc counts
     */
    public static void main(String[] args) {
        Car car = new Car("x{");  // foo( in a comment
        car.getModel();
        String s = "bar(";
        helper(1, 2);
        super.toString();
    }
    interface Shape { double area(); }
    Main(int x) { this.a = x; }
}
'''


def test_extract_file_snippet():
    rows = EX.extract_file("p", "Main.java", SNIPPET)
    kinds = [(r["kind"], r["class_name"], r["method"], r["name"]) for r in rows]
    assert ("type", "Main", None, None) in kinds
    assert ("type", "Shape", None, None) in kinds
    assert ("type", "Fake", None, None) not in kinds  # inside a comment
    methods = {r["method"]: r for r in rows if r["kind"] == "method"}
    assert methods["main"]["loc"] == 10 and methods["main"]["params"] == 1
    assert methods["area"]["loc"] == 0
    assert methods["Main"]["params"] == 1
    invs = {(r["name"], r["receiver"]) for r in rows if r["kind"] == "inv"}
    assert invs == {("getModel", "car"), ("helper", None)}
    assert [r["name"] for r in rows if r["kind"] == "super_inv"] == ["toString"]
    fields = [r for r in rows if r["kind"] == "field"]
    assert len(fields) == 1 and fields[0]["name"] == "a,b"
    locals_ = {r["name"]: r["type_name"] for r in rows if r["kind"] == "local"}
    assert locals_["car"] == "Car"


def test_scan_and_local_calls(spark):
    root = tempfile.mkdtemp(prefix="cw-src-", dir="/tmp")
    os.makedirs(os.path.join(root, "com", "company"))
    with open(os.path.join(root, "com", "company", "Main.java"), "w") as f:
        f.write(SNIPPET)
    with open(os.path.join(root, "com", "company", "Car.java"), "w") as f:
        f.write("package com.company;\npublic class Car { String getModel() { return null; } }\n")
    with open(os.path.join(root, "notes.txt"), "w") as f:
        f.write("class Nope {}")
    src = EX.scan_sources(spark, root, "demo")
    assert src.count() == 2
    facts = EX.extract_facts(src)
    types = {r.class_fqn for r in EX.fact_types(facts).collect()}
    assert types == {"com.company.Main", "com.company.Shape", "com.company.Car"}
    lc = EX.local_receiver_calls(facts).collect()
    assert [(r.method, r.variable, r.method_name, r.type_name) for r in lc] == [("main", "car", "getModel", "Car")]


def facts_of(body, kind):
    return [r for r in EX.extract_file("p", "A.java", body) if r["kind"] == kind]


FORMS = '''package a.b;
@Entity(name = "x") public class A<T extends Comparable<T>> extends Base<T> implements I, J {
    @Column(name="x") private int a;
    @Inject Foo b;
    private final Map<String, List<Integer>> m = new HashMap<String, List<Integer>>(), n = null;
    int[] arr = {1, 2}, other[];
    static { init(); }
    @SuppressWarnings("x") public void m1(){ foo(); }
    void m2(@Named("x") int a, final Map<String, Integer> b) throws E1, E2 { foo(a); }
    public <K, V> Map<K, V> gen(K k, V... v) { return null; }
    @Override
    public String toString() {
        int a = 1, b = 2; int c[] = new int[3];
        for (Foo f : foos) { f.go(); }
        try (Reader r = open()) { r.read(); }
        final List<String> l = new java.util.ArrayList<>();
        Object o = new Runnable() { public void run() { inner(); } @Override public int size() { return 1; } };
        other.thing().next(x -> call(x));
        return super.toString();
    }
    enum Color { RED(1) { int z() { return 0; } }, BLUE(2); int v; Color(int v) { this.v = v; } static class InEnum { void e() { en(); } } }
    record Point(int x, int y) { Point { check(); } class InRecord { int q; } }
    @interface Ann { String value() default ""; }
    interface Shape { double area(); default int two() { return 2; } }
    A(int x) { this.a = x; }
    abstract int none();
}
class Second { int z; }
'''


def test_forms_that_must_not_be_lost():
    types = {(r["class_name"], r["superclass"]) for r in facts_of(FORMS, "type")}
    assert types == {("A", "Base"), ("InEnum", None), ("InRecord", None), ("Shape", None), ("Second", None)}
    methods = {(r["class_name"], r["method"], r["params"]) for r in facts_of(FORMS, "method")}
    assert methods == {("A", "m1", 0), ("A", "m2", 2), ("A", "gen", 2), ("A", "toString", 0), ("A", "A", 1), ("A", "none", 0),
                       ("InEnum", "e", 0), ("Shape", "area", 0), ("Shape", "two", 0)}
    fields = [(r["class_name"], r["name"], r["type_name"]) for r in facts_of(FORMS, "field")]
    assert fields == [("A", "a", "int"), ("A", "b", "Foo"), ("A", "m,n", "Map"), ("A", "arr,other", "int[]"),
                      ("InRecord", "q", "int"), ("Second", "z", "int")]
    calls = {(r["method"], r["name"], r["receiver"]) for r in facts_of(FORMS, "inv")}
    assert calls == {("m1", "foo", None), ("m2", "foo", None), ("toString", "go", "f"), ("toString", "open", None),
                     ("toString", "read", "r"), ("toString", "inner", None), ("toString", "thing", "other"),
                     ("toString", "next", None), ("toString", "call", None), ("e", "en", None)}
    assert [r["name"] for r in facts_of(FORMS, "super_inv")] == ["toString"]
    locals_ = [(r["name"], r["type_name"], r["init"]) for r in facts_of(FORMS, "local")]
    assert locals_ == [("a", "int", "1"), ("b", "int", "2"), ("c", "int", "new int[3]"), ("f", "Foo", None),
                       ("r", "Reader", "open()"), ("l", "List", "new java.util.ArrayList<>()"), ("o", "Object", locals_[-1][2])]
    assert {r["package"] for r in EX.extract_file("p", "A.java", FORMS)} == {"a.b"}


def test_broken_empty_and_long_sources():
    import time
    assert EX.extract_file("p", "x", "") == [] and EX.extract_file("p", "x", None) == []
    for text in ("class A {", "class A { void m( { foo(); }", "}}}", "class", "@", "class A { int", "new", "class A { void m() { a."):
        EX.extract_file("p", "x", text)
    far = "class A { void m() { Object o = new " + "/* " + "x" * 1000 + " */ Foo(); } }"
    assert [r["name"] for r in EX.extract_file("p", "x", far) if r["kind"] == "inv"] == []
    big = "package p;\nclass Big {\n" + "".join(f"  @A(\"q\") public int m{i}(int a) {{\n    foo{i}(a);\n    int v = {i};\n  }}\n  int f{i};\n"
                                               for i in range(4000)) + "}\n"
    t = time.process_time()
    rows = EX.extract_file("p", "Big.java", big)
    assert time.process_time() - t < 3
    assert sum(r["kind"] == "method" for r in rows) == 4000 and sum(r["kind"] == "field" for r in rows) == 4000


def test_local_calls_stay_in_their_project_and_see_files_up_to_their_own(spark):
    rows = [("A", "Main.java", "package q; class Main { void m() { Car c = x; c.go(); } }"),
            ("B", "Main.java", "package q; class Main { void other() { Bus c = x; c.stop(); } }"),
            ("A", "Early.java", "package q; class Early { void e() { Plane p = x; } }"),
            ("A", "Zlast.java", "package q; class Zlast { void e() { Ship c = x; Ship late = y; } }"),
            ("A", "Main2.java", "package q2; class Main { void m2() { p.fly(); late.sail(); c.go(); } }")]
    facts = EX.extract_facts(spark.createDataFrame(rows, "project string, path string, text string"))
    by_method = {tuple(r) for r in EX.local_receiver_calls(facts).collect()}
    assert by_method == {("A", "q.Main", "m", "c", "go", "Car"), ("B", "q.Main", "other", "c", "stop", "Bus")}
    last = {tuple(r) for r in EX.local_receiver_calls(facts, scope="global_last").collect()}
    assert last == by_method | {("A", "q2.Main", "m2", "p", "fly", "Plane"), ("A", "q2.Main", "m2", "c", "go", "Car")}
